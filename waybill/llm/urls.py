"""URL rules, and redirect equivalence: a block reaches every alias of a page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.llm.common import lower_ascii
from waybill.llm.components import components

# The rules of the registered query, (host and path, verdict).
RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]

LINK = r"(?i)<link\b(?=[^>]*\brel\s*=\s*[\"']?canonical\b)[^>]*?\bhref\s*=\s*[\"']?([^\"'\s>]+)"
REFRESH = r"(?i)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b)[^>]*?\burl\s*=\s*[\"']?([^\"'\s>]+)"


def after_scheme(url: Column) -> Column:
    """What follows the first ``://`` up to ``?``, ``#`` or the end; empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    return F.substring_index(F.substring_index(F.coalesce(rest, F.lit("")), "#", 1), "?", 1)


def host(url: Column) -> Column:
    return lower_ascii(F.substring_index(after_scheme(url), "/", 1))


def path(url: Column) -> Column:
    rest = after_scheme(url)
    return F.when(F.instr(rest, "/") > 0, F.substring(rest, F.instr(rest, "/"), F.length(rest))).otherwise("")


def fitting_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest rule that fits as a struct (rule, verdict), or null; of two equally long ones, allow wins.

    A rule's host stands for itself and all subdomains, its path for all that start with it.
    """
    listed = sorted(set(rules), key=lambda r: (-len(r[0]), r[1] != "allow", r[0]))
    if not listed:
        return F.lit(None).cast("struct<rule:string,verdict:string>")
    table = F.array(*[
        F.struct(F.lit(r).alias("rule"), F.lit(v).alias("verdict"), F.lit(r[: r.index("/")]).alias("host"),
                 F.lit(r[r.index("/"):]).alias("path"))
        for r, v in listed
    ])
    fits = lambda r: (
        (host == r["host"]) | F.endswith(host, F.concat(F.lit("."), r["host"]))) & F.startswith(path, r["path"])
    first = F.get(F.filter(table, fits), F.lit(0))
    return F.when(first.isNotNull(), F.struct(first["rule"].alias("rule"), first["verdict"].alias("verdict")))


SCHEME = "^[A-Za-z][A-Za-z0-9+.-]*:"
SITE = "^([A-Za-z][A-Za-z0-9+.-]*://)([^/?#]*@)?([^/?#]*)"


def _without_dots(path: Column) -> Column:
    """A path from its first ``/`` on with ``.`` and ``..`` followed."""
    steps = F.split(path, "/")
    last = F.element_at(steps, -1)
    walked = F.aggregate(
        F.slice(steps, 2, F.greatest(F.size(steps) - 1, F.lit(0))), F.array().cast("array<string>"),
        lambda done, step: F.when(step == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))))
        .when(step == ".", done).otherwise(F.concat(done, F.array(step))))
    ends = F.when(last.isin(".", ".."), F.concat(walked, F.array(F.lit("")))).otherwise(walked)
    return F.concat(F.lit("/"), F.array_join(ends, "/"))


def address(url: Column) -> Column:
    """A url as a node: without its fragment, which no server sees, scheme and host in lower case, dot segments followed."""
    bare = F.substring_index(url, "#", 1)
    part = lambda k: F.regexp_extract(bare, SITE, k)
    site = F.concat(lower_ascii(part(1)), part(2), lower_ascii(part(3)))
    rest = F.substring(bare, F.length(site) + 1, F.length(bare))
    path = F.substring_index(rest, "?", 1)
    query = F.substring(rest, F.length(path) + 1, F.length(rest))
    straight = F.when(F.contains(path, F.lit("/.")) & (site != ""), _without_dots(path)).otherwise(path)
    return F.concat(site, straight, query)


def resolved(to: Column, url: Column) -> Column:
    """The target ``to`` of a link on page ``url``; null if that needs a site and the page's url has none."""
    base = F.substring_index(F.substring_index(url, "#", 1), "?", 1)
    site = F.regexp_extract(base, SITE, 0)
    inside = F.substring(base, F.length(site) + 1, F.length(base))
    folder = F.when(inside == "", "/").otherwise(F.regexp_extract(inside, "^.*/", 0))
    full = (
        F.when(F.startswith(to, F.lit("//")), F.concat(F.regexp_extract(base, SCHEME, 0), to))
        .when(F.startswith(to, F.lit("/")), F.concat(site, to))
        .when(F.startswith(to, F.lit("?")), F.concat(base, to))
        .when(F.startswith(to, F.lit("#")), url)
        .otherwise(F.concat(site, folder, to)))
    return F.when(F.rlike(to, F.lit(SCHEME)), to).when(site != "", full)


def alias_links(pages: DataFrame, redirects: DataFrame | None = None) -> DataFrame:
    """Edges ``(a, b)`` between addresses: all canonical links and refresh redirects in ``html``, and rows of ``redirects``
    (``source``, ``target``). Relative targets are resolved against the page's url; ``<base>`` is not read."""
    found = pages.where("url is not null and html is not null").select("url", F.explode(F.concat(
        F.regexp_extract_all("html", F.lit(LINK), 1), F.regexp_extract_all("html", F.lit(REFRESH), 1))).alias("to"))
    to = F.regexp_replace("to", "(?i)&(amp|#0*38|#x0*26);", "&")
    links = found.where("to != ''").select(
        address(F.col("url")).alias("a"), address(resolved(to, F.col("url"))).alias("b")).where(F.rlike("b", F.lit(SCHEME + "//.*[^/]")))
    if redirects is not None:
        target = F.coalesce(resolved(F.col("target"), F.col("source")), F.col("target"))
        links = links.unionByName(redirects.select(address(F.col("source")).alias("a"), address(target).alias("b")))
    return links.where("a is not null and b is not null")


def judged_urls(pages: DataFrame, rules: list[tuple[str, str]] = RULES, redirects: DataFrame | None = None) -> DataFrame:
    """Every page (``page_id``, ``url``, ``html``) with host, path, the rule that fits, and a verdict.

    A page without a rule takes the verdict of its aliases, the pages and link
    targets it reaches over canonical links and redirects in either direction:
    allow if one of them is explicitly allowed, else block if one is blocked,
    else allow. A rule of its own always wins. Null urls have no host, path,
    rule or alias and are allowed. Repeated rows are judged alike; extra columns
    are left out. Rules are a short list, tried per row inside the scan; the
    aliases are connected components, joined back by address. Only SQL functions.
    """
    rule = fitting_rule(F.col("host"), F.col("path"), rules)
    own = pages.select("page_id", "url", "html").withColumns({"host": host(F.col("url")), "path": path(F.col("url"))})
    own = own.withColumn("fit", rule)
    links = alias_links(pages, redirects)
    classes = components(links)
    # A link target may be no page itself; its own address is judged like a page's.
    sides = classes.select("component", "node").withColumns({"host": host(F.col("node")), "path": path(F.col("node"))})
    voices = sides.withColumn("fit", rule).groupBy("component").agg(
        F.max((F.col("fit.verdict") == "allow").cast("int")).alias("allows"),
        F.max((F.col("fit.verdict") == "block").cast("int")).alias("blocks"))
    told = classes.join(voices, "component").where("allows = 1 or blocks = 1").select(
        "node", F.when(F.col("allows") == 1, "allow").otherwise("block").alias("told"))
    out = own.drop("html").withColumn("node", address(F.col("url"))).join(told, "node", "left")
    return out.select(
        "page_id", "host", "path", F.col("fit.rule").alias("rule"),
        F.coalesce(F.col("fit.verdict"), F.col("told"), F.lit("allow")).alias("verdict"))
