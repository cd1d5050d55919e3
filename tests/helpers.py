"""Small hand-written runs."""

import json

from waybill import route_messages

XSD_ANY = (
    '<xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema"><xs:element name="a"><xs:complexType mixed="true">'
    '<xs:sequence><xs:any processContents="skip" minOccurs="0" maxOccurs="unbounded"/></xs:sequence>'
    '<xs:anyAttribute processContents="skip"/></xs:complexType></xs:element></xs:schema>'
)


def route(*targets, validate="any", sync=None, **more):
    return json.dumps({"validate": validate, "sync": sync, "targets": list(targets), **more})


def target(*paths, id="t", url="u", **more):
    return {"id": id, "transformations": [list(p) for p in paths], "targetPath": url, **more}


def one_path(*steps, **more):
    return route(target(list(steps), **more))


def message_table(spark, rows):
    return spark.createDataFrame(rows, "msg_id string, content string, attrs map<string,string>")


def registries(spark, docs, xsd=XSD_ANY):
    routes = spark.createDataFrame(list(docs.items()), "process string, doc string")
    schemas = spark.createDataFrame([("any", xsd), ("broken", "<nope"), ("empty", "")], "name string, xsd string")
    return routes, schemas


def run(spark, cases, settings=None, reshapes=None):
    """``cases``: name -> (route document, content, attributes); the name is process and message id."""
    routes, schemas = registries(spark, {name: case[0] for name, case in cases.items() if case[0] is not None})
    rows = [(n, c[1], {"business.process.name": n, **(c[2] if len(c) > 2 else {})}) for n, c in cases.items()]
    return route_messages(message_table(spark, rows), routes, schemas, reshapes, settings)


class Routed:
    """Collected rows by message."""

    def __init__(self, run_):
        self.rows = sorted(run_.routed().collect(), key=lambda r: r["lineage"])

    def of(self, name, *keys):
        """(lineage after the id, route, attributes asked for) of one message."""
        return [
            (r["lineage"][len(name) + 1:], r["route"], *[r["attrs"].get(k) for k in keys])
            for r in self.rows if r["msg_id"] == name
        ]

    def one(self, name):
        (row,) = [r for r in self.rows if r["msg_id"] == name]
        return row
