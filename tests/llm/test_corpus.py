"""Shards, packing, lengths, near-duplicates, substrings, decontamination, tool calls: edge rows and brute force."""

import json
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from waybill.llm import minhash, tools
from waybill.llm.common import numbered
from waybill.llm.decontaminate import Search, decontaminated, lcs, leaks
from waybill.llm.hashing import Rolling, word_marks
from waybill.llm.lengths import at_limits, length_histogram, quantiles
from waybill.llm.minhash import Near, near_duplicates, near_duplicates_removed
from waybill.llm.packing import best_fill, fill_plan, packed, sequences
from waybill.llm.shards import kd_shards
from waybill.llm.substrings import repeats_removed
from waybill.llm.tokens import encoder
from waybill.llm.tools import linked_chats

FOLDER = "/root/testdata/sf0.001"


def prose(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(2, 7))) for _ in range(n))


def ordinary(text):
    import public_tokenizers

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tok.encode_special_tokens = True
    return tok.encode(text, add_special_tokens=False).ids


def test_numbers_are_gapless_in_a_hot_group(spark):
    df = spark.range(5000).selectExpr("id", "if(id % 3 = 0, 0, id % 7) as g", "'x' as slot")
    rows = numbered(df, "g", ["id"], "slot", rows_per_task=200).collect()
    by = {}
    for r in rows:
        by.setdefault(r.g, []).append(r.slot)
    assert len(rows) == 5000 and all(sorted(v) == list(range(len(v))) for v in by.values())


def test_shards(spark):
    r = random.Random(1)
    rows = [(i, "x" * r.randint(0, 900), "en", "hot" if i % 3 else f"s{i % 9}", r.randint(0, 99)) for i in range(2000)]
    rows += [(None, None, None, None, None), (7, "é", "fr", "s", 1), (7, "é", "fr", "s", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int")
    got = kd_shards(df.withColumn("shard", df.lang), ["lang", "source", "n_chars", "doc_id"], shards=16).collect()
    assert len(got) == len(rows)
    sums, slots = {}, {}
    for x in got:
        sums[x.shard] = sums.get(x.shard, 0) + x.size
        slots.setdefault(x.shard, []).append(x.slot)
    assert sorted(sums) == list(range(16)) and all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert max(sums.values()) - min(sums.values()) < 4 * 900
    want = sorted((str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    assert sorted((str(x.doc_id), x.size, x.text_crc32) for x in got) == want
    assert kd_shards(df.limit(0), ["lang"], shards=16).count() == 0
    few = kd_shards(df, ["n_chars"], target_bytes=300_000).select("shard").distinct().count()
    assert few == 4


def tree(rows, k, widths):
    """The k-d tree, one row after another: rows are (size, coordinates)."""
    if k == 1:
        return [sorted(r[1] for r in rows)]
    span = [max(r[1][d] for r in rows) - min(r[1][d] for r in rows) for d in range(len(widths))]
    d = max(range(len(widths)), key=lambda i: span[i] / (widths[i] or 1.0))
    wanted, below, ordered = sum(r[0] for r in rows) * (k // 2) / k, 0, sorted(rows, key=lambda r: r[1][d])
    for i, (size, _) in enumerate(ordered):
        if below + size >= wanted:
            at = i + (below + size / 2 <= wanted)
            return tree(ordered[:at], k // 2, widths) + tree(ordered[at:], k - k // 2, widths)
        below += size


def test_shards_are_the_tree_of_weighted_medians(spark):
    r = random.Random(9)
    urls = [f"https://example.net/{i:05d}" for i in range(300)]  # alike in far more than six bytes
    rows = [(i, "x" * r.randint(0, 400), u, v) for i, (u, v) in enumerate(zip(r.sample(urls, 300), r.sample(range(10**6), 300)))]
    df = spark.createDataFrame(rows, "doc_id long, text string, url string, v long").repartition(5)
    got = {}
    for x in kd_shards(df, ["url", "v"], shards=5).collect():
        got.setdefault(x.shard, []).append(x.doc_id)
    point = {(float(urls.index(u)), float(v)): i for i, _, u, v in rows}
    sized = [(len(t) + 1, (float(urls.index(u)), float(v))) for _, t, u, v in rows]
    widths = [max(s[1][d] for s in sized) - min(s[1][d] for s in sized) for d in (0, 1)]
    want = [sorted(point[c] for c in leaf) for leaf in tree(sized, 5, widths)]
    assert [sorted(got[i]) for i in range(5)] == want


def test_shards_end_on_infinite_numbers(spark):
    rows = [(i, "x" * 9, [float("inf"), float("-inf"), float("nan"), None, 1.5e308, float(i)][min(i, 5)], None) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, v double, none string")
    got = kd_shards(df, ["v", "none"], shards=4).collect()
    assert sorted(x.doc_id for x in got) == list(range(40)) and {x.shard for x in got} == {0, 1, 2, 3}
    place = {x.doc_id: x.shard for x in got}
    assert place[1] == place[2] == 0 and place[0] == place[4] == 3


@given(st.dictionaries(st.integers(1, 40), st.integers(1, 4), max_size=7), st.integers(0, 60))
@settings(max_examples=150, deadline=None)
def test_best_fill_is_closest(counts, room):
    used = best_fill(counts, room)
    sums = {0}
    for length, n in counts.items():
        sums = {s + k * length for s in sums for k in range(n + 1) if s + k * length <= room}
    assert sum(length * k for length, k in used.items()) == max(sums)
    assert all(k <= counts[length] for length, k in used.items())


def test_packing(spark):
    texts = [None, "", "a", prose(1, 4000), prose(2, 900), prose(2, 900), "<|endoftext|> é \U0001F600"] + [prose(i, i) for i in range(60)]
    df = spark.createDataFrame([(None if i == 2 else i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, offset int")
    rows = packed(df, with_ids=True)
    pieces = [r.asDict() for r in rows.collect()]
    by_doc, by_seq = {}, {}
    for p in pieces:
        by_doc.setdefault(p["doc_id"], []).append(p)
        by_seq.setdefault(p["sequence_id"], []).append(p)
        assert zlib.crc32(bytes(p["ids"])) == p["ids_crc32"] and len(p["ids"]) == 4 * p["length"]
    for i, t in enumerate(texts):
        mine = sorted(by_doc[None if i == 2 else i], key=lambda p: p["start"])
        ids = np.frombuffer(b"".join(bytes(p["ids"]) for p in mine), dtype="<u4").tolist()
        assert ids == ordinary(t or "") + [1] and {p["doc_tokens"] for p in mine} == {len(ids)}
        assert [p["start"] for p in mine] == list(np.cumsum([0] + [p["length"] for p in mine])[:-1])
    assert sorted(by_seq) == list(range(len(by_seq)))
    for s in by_seq.values():
        s.sort(key=lambda p: p["offset"])
        assert [p["offset"] for p in s] == list(np.cumsum([0] + [p["length"] for p in s])[:-1])
        assert sum(p["length"] for p in s) <= 2048
    total = sum(p["length"] for p in pieces)
    assert len(by_seq) == -(-total // 2048)  # no fewer sequences can hold the ids
    whole = {r.sequence_id: r for r in sequences(rows).collect()}
    assert all(len(whole[k].ids) == 4 * whole[k].tokens and whole[k].tokens == sum(p["length"] for p in s) for k, s in by_seq.items())
    assert packed(df.limit(0)).count() == 0


def test_added_tokens_in_registered_queries(spark, tmp_path):
    import public_tokenizers

    from corpus_pipeline import STAGES
    from waybill.llm.catalog import QUERIES

    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["hello <|endoftext|> there", "<|endoftext|>", "a<|endoftext|><|endoftext|>b \n", "<|endoftext|", "é  x", *prose(1, 40).split()]
    want = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert [encoder(added=True)(t).tolist() for t in texts] == want and want[0][2] == 50256
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    for rows in (QUERIES["op4_packing"](spark, str(tmp_path)), dict(STAGES)["packing"](spark, docs, str(tmp_path))):
        got = {r.doc_id: (r.doc_tokens, r.ids_crc32) for r in rows.collect()}
        assert got == {i: (len(w) + 1, zlib.crc32(np.array([*w, 1], dtype="<u4").tobytes())) for i, w in enumerate(want)}
    assert sum(r.tokens for r in QUERIES["op10_token_lengths"](spark, str(tmp_path)).collect()) == sum(map(len, want))


def test_fill_plan_is_bounded_by_lengths():
    plan, n = fill_plan({700: 10**9, 3: 5, 2048: 7, 650: 10**8}, 2048)
    assert len({r[4] for r in plan}) <= 12
    for length, count in {700: 10**9, 3: 5, 2048: 7, 650: 10**8}.items():
        assert sum(r[2] - r[1] for r in plan if r[0] == length) == count
    assert fill_plan({}, 2048) == ([], 0)


def test_lengths(spark):
    texts = [None, "", "one", "one", prose(3, 5000), prose(4, 30)]
    df = spark.createDataFrame([(t, 5) for t in texts], "text string, length int")
    hist = length_histogram(df)
    sizes = [len(encoder()(t)) if t else 0 for t in texts]
    rows = {r.length: r for r in hist.collect()}
    assert set(rows) == set(sizes)
    for n, r in rows.items():
        assert r.docs == sizes.count(n) and r.docs_longer == sum(s > n for s in sizes)
        assert r.tokens_longer == sum(s for s in sizes if s > n) and r.tokens_kept == sum(min(s, n) for s in sizes)
        assert r.tokens_kept + r.tokens_cut == sum(sizes)
    for r in at_limits(hist, [0, 1, 50, 10**6]).collect():
        assert r.tokens_kept == sum(min(s, r.context) for s in sizes) and r.docs_cut == sum(s > r.context for s in sizes)
    assert [r.length for r in quantiles(hist, [0.0, 0.5, 1.0]).collect()] == [0, sorted(sizes)[2], max(sizes)]
    assert length_histogram(df.limit(0)).count() == 0


def near_brute(texts, width, percent):
    sets = []
    for t in texts:
        w = [x.lower() for x in (t or "").encode().split()]
        sets.append({tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set())
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = root[i], root[j]
                root = [min(a, b) if x in (a, b) else x for x in root]
    return [len(s) for s in sets], root


def near_texts():
    r, out = random.Random(5), [None, "", " \n", "Two Words", "two words", "one", "É x y z"]
    base = prose(9, 120).split()
    for _ in range(60):  # one large group of near copies, many of them not linked with each other
        w = list(base)
        for _ in range(r.randint(0, 5)):
            w[r.randrange(len(w))] = prose(r.random(), 1)
        out.append(" ".join(w))
    out += [prose(9, 120).upper()] * 20 + [prose(i, 40) for i in range(30)] + [prose(77, 20_000), prose(77, 20_000) + " tail"]
    return out


def test_a_group_just_short_of_the_limit(spark, monkeypatch):
    """Copies that miss the limit to their centre and to each other: rows about double with the group, no link is lost."""
    r = random.Random(4)
    base, rows = prose(77, 170).split(), {}

    def group(n):
        texts = [" ".join(base)]
        for i in range(1, n):
            words = list(base)
            for at in r.sample(range(170), 6):
                words[at] = f"w{r.randint(0, 10 ** 6)}"
            texts.append(" ".join(words))
        # A chain that only pairs among the copies hold together.
        for i in range(1, n, 20):
            words = texts[i].split()
            words[0] = "chain"
            texts.append(" ".join(words))
        return list(enumerate(texts))

    seen = []
    pairs = minhash._rare_pairs
    monkeypatch.setattr(minhash, "_rare_pairs", lambda *x: (seen.append(pairs(*x)), seen[-1])[1])
    for n in (90, 180):
        docs = group(n)
        got = {x.doc_id: x.component_id for x in near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), Near()).collect()}
        sets = {i: set(minhash.shingles(t, 3).tolist()) for i, t in docs}
        parent = {i: i for i in sets}

        def root(i):
            while parent[i] != i:
                i = parent[i]
            return i

        for i in sets:
            for j in range(i):
                if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                    x, y = sorted((root(i), root(j)))
                    parent[y] = x
        assert got == {i: root(i) for i in sets}
        rows[n] = seen[-1].count() if seen else 0
    assert rows[180] <= 2.5 * max(rows[90], 50)


@given(st.sets(st.integers(0, 2 ** 63), max_size=60), st.sets(st.integers(0, 2 ** 63), max_size=60))
@settings(max_examples=60, deadline=None)
def test_parity_never_differs_more_than_the_sets(x, y):
    px, py = (minhash.parity(np.array(sorted(s), dtype=np.uint64)) for s in (x, y))
    assert len(px) == minhash.PARITY
    assert sum(int(v).bit_count() for v in (px ^ py).view(np.uint64)) <= len(x ^ y)


def test_near_duplicates(spark):
    texts = near_texts()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "'n' as node", "1 as bucket")
    rows = sorted(near_duplicates(df, Near()).collect(), key=lambda r: r.doc_id)
    sizes, root = near_brute(texts, 3, 85)
    assert [r.n_shingles for r in rows] == sizes
    assert [r.component_id for r in rows] == root
    assert [r.kept for r in rows] == [i == x for i, x in enumerate(root)]


def test_near_duplicates_removed(spark):
    five = prose(1, 50)
    rows = [(1, five), (1, five), (2, five), (1, prose(2, 50)), (None, five), (None, prose(3, 50)), (None, prose(3, 50)), (4, None), (5, ""), (6, None)]
    df = spark.createDataFrame([(*r, "m") for r in rows], "doc_id long, text string, text_mark string")
    out = near_duplicates_removed(df)
    assert out.columns == df.columns
    got = sorted(map(str, ((r.doc_id, r.text) for r in out.collect())))
    assert got == sorted(map(str, [(1, five), (1, prose(2, 50)), (None, prose(3, 50)), (4, None), (5, ""), (6, None)]))
    assert near_duplicates_removed(df.limit(0)).count() == 0 and near_duplicates(df.limit(0)).count() == 0


def test_rolling_hashes_tell_windows_apart():
    _, marks = word_marks(prose(5, 300) + " " + prose(5, 300))
    got = Rolling(0x9E3779B97F4A7C15, 20)(marks)
    assert len(got) == 581 and len(set(got.tolist())) == 300
    assert not len(Rolling(3, 20)(marks[:19]))


def repeats_brute(rows, width):
    first = {}
    words = [(i, (t or "").encode().split()) for i, t in rows]
    key = lambda i: (i is None, i or 0)
    for i, w in words:
        for s in range(len(w) - width + 1):
            g = tuple(w[s:s + width])
            first[g] = min(first.get(g, (key(i), s)), (key(i), s))
    out = []
    for i, w in words:
        gone = {s + k for s in range(len(w) - width + 1) if first[tuple(w[s:s + width])] < (key(i), s) for k in range(width)}
        out.append((str(i), len(w), len(gone), b" ".join(x for n, x in enumerate(w) if n not in gone).decode()))
    return sorted(out)


def test_repeats_removed(spark, monkeypatch):
    monkeypatch.setattr("waybill.llm.substrings.BATCH_BYTES", 3000)
    shared, loop = prose(1, 60), " ".join(["la"] * 100)
    rows = [(i, f"{prose(i + 50, 15)} {shared if i % 3 else ''}\t{prose(i + 90, 15)}") for i in range(40)]
    rows += [(40, loop), (41, None), (42, ""), (None, shared), (None, shared + " x"), (3, shared), (3, shared), (43, "short one"),
             (44, prose(2, 20_000)), (45, prose(2, 20_000)), (46, shared + " " + shared), (0, prose(50, 15) + " é " + shared)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, batch int")
    got = repeats_removed(df).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_text) for r in got) == repeats_brute(rows, 20)
    for r in got:
        assert sum(s.end - s.start for s in r.removed) == r.n_removed
        assert all(a.end < b.start for a, b in zip(r.removed, r.removed[1:]))  # maximal
    assert repeats_removed(df.limit(0)).count() == 0


@given(st.lists(st.integers(0, 3), max_size=9), st.lists(st.integers(0, 3), max_size=9))
@settings(max_examples=200, deadline=None)
def test_lcs(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    assert lcs(a, b) == table[-1][-1]


def test_decontamination(spark):
    items = [(i, f"{prose(1000 + i, 18 + i)}. {prose(2000 + i, 8)}.") for i in range(12)] + [(98, None), (99, "")]
    r, rows, want = random.Random(3), [], set()
    for i in range(80):
        text = prose(i, r.randint(20, 400)).split()
        if i % 4 == 0:
            item = items[i // 4 % 12]
            words = item[1].split()
            if i % 8 == 0:  # a paraphrase: every fifth word of the question is another
                words[: len(words) - 8] = [w if n % 5 else "zz" for n, w in enumerate(words[: len(words) - 8])]
            at = r.randrange(len(text))
            text[at:at] = " ".join(words).upper().split() if i % 3 == 0 else words
            want.add((i, item[0]))
        rows.append((i, " ".join(text)))
    rows += [(100, None), (101, ""), (None, items[0][1]), (102, items[1][1]), (102, items[1][1]), (103, prose(5, 20_000) + " " + items[2][1])]
    df = spark.createDataFrame([(*x, "m") for x in rows], "doc_id long, text string, text_mark string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = leaks(df, bench).collect()
    got = [(x.doc_id, x.item_id) for x in found]
    assert sorted(map(str, got)) == sorted(map(str, [*want, (None, 0), (102, 1), (102, 1), (103, 2)]))
    clean = decontaminated(df, bench)
    assert clean.columns == df.columns
    bad = {i for i, _ in want} | {102, 103}
    assert sorted(x.doc_id for x in clean.collect()) == [i for i in [*range(80), 100, 101] if i not in bad]
    assert leaks(df.limit(0), bench).count() == 0 and leaks(df, bench.limit(0)).count() == 0
    assert decontaminated(df, bench.limit(0)).count() == len(rows)


def planted(spark, bench, copies, seed=4, s=Search()):
    """``leaks`` of long documents that hold one of the copies each, as (document, item)."""
    r, rows = random.Random(seed), []
    for d, words in enumerate(copies):
        host = prose(5000 + d, 300).split()
        at = r.randrange(len(host))
        rows.append((d, " ".join(host[:at] + words + host[at:])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return {(x.doc_id, x.item_id): x for x in leaks(docs, spark.createDataFrame(bench, "item_id long, text string"), s).collect()}


def test_decontamination_of_brief_items(spark):
    sizes = [3, 4, 5, 6, 7, 8, 9]
    bench = [(i, prose(7000 + i, n)) for i, n in enumerate(sizes)]
    copies = [t.split() for _, t in bench] + [t.split()[::-1] for _, t in bench[:5]]
    found = planted(spark, bench, copies)
    assert sorted(found) == [(i, i) for i in range(len(sizes))]
    assert all(found[i, i].end - found[i, i].start == n and found[i, i].lcs_share == 1 for i, n in enumerate(sizes) if n < 8)


def test_decontamination_finds_all_that_its_rule_accepts(spark):
    r, bench, copies = random.Random(9), [], []
    for n in (15, 18, 22, 26, 40, 70):
        for share in (0.56, 0.6, 0.65, 0.7, 0.8):
            words = prose(9000 + len(bench), n).split()
            bench.append((len(bench), " ".join(words[:-4]) + ". " + " ".join(words[-4:])))
            for x in r.sample(range(n - 4), int(n * (1 - share))):
                words[x] = f"other{x}"
            copies.append(words)
    assert sorted(planted(spark, bench, copies)) == [(i, i) for i in range(len(bench))]


def test_decontamination_judges_each_stretch(spark):
    words = [f"q{i}" for i in range(24)] + [f"a{i}" for i in range(6)]
    bench = [(1, " ".join(words[:24]) + ". " + " ".join(words[24:]))]
    asked, answered = words[:21], words[12:]  # shares 0.7 without the answer, 0.6 with it
    found = planted(spark, bench, [asked + prose(1, 200).split() + answered, asked, answered])
    assert sorted(found) == [(0, 1), (2, 1)]
    assert abs(found[0, 1].lcs_share - 0.6) < 1e-6 and found[0, 1].answer_share == 1


def test_decontamination_of_moved_passages_by_the_latent_space(spark):
    """The item's words in another order and its answer: the cosine says whether that is a leak."""
    words = list(dict.fromkeys(prose(9500, 600).split()))[:66]
    bench = [(1, " ".join(words[:60]) + ". " + " ".join(words[60:]))]
    moved = words[40:60] + words[20:40] + words[:20] + words[60:]
    others = [random.Random(i).sample(words, 40) for i in range(100)]
    copies = [moved, moved[:60], words, *others]
    found = planted(spark, bench, copies)
    assert sorted(found) == [(0, 1), (2, 1)]
    assert found[0, 1].lcs_share < 0.55 and found[0, 1].answer_share == 1
    assert sorted(planted(spark, bench, copies, s=Search(alike=1.01))) == [(2, 1)]


def call(ident, name="search", **arguments):
    return "<tool_call>" + json.dumps({"id": ident, "name": name, "arguments": arguments}) + "</tool_call>"


def result(ident, content):
    return "<tool_result>" + json.dumps({"id": ident, "content": content}) + "</tool_result>"


def test_tool_calls(spark):
    turns = [
        (1, 0, "user", "hi \"there\"\n"), (1, 1, "assistant", "go " + call("b", query="$a", limit=3) + call("a", query="é")),
        (1, 2, "tool", result("a", {"y": 1, "x": [2]}) + result("b", "done") + result("b", "again") + result("q", 0)),
        (1, 3, "assistant", call("c", query=5) + call("d", "nope") + call("a", query="twice") + "<tool_call>{</tool_call>"),
        (2, 0, "assistant", call("a", query="$z") + call("z", query="$a") + call("u", query="${b}") + call("e", "fetch", url="$u")),
        (2, 1, "tool", result("u", None)), (None, 0, None, None), (None, 1, "tool", call("n", query="x") + result("n", "r")),
        (3, None, "user", ""), (3, None, "user", ""),
    ]
    df = spark.createDataFrame([(*t, "s") for t in turns], "conv_id long, turn long, role string, text string, status string")
    rows = linked_chats(df).collect()
    got = {(r.conv_id, r.turn, r.place): r for r in rows}
    status = {k: (r.status, r.step) for k, r in got.items() if r.status != "message"}
    assert status == {
        (1, 1, 1): ("linked", 1), (1, 1, 2): ("linked", 0), (1, 2, 3): ("repeated", None), (1, 2, 4): ("orphan", None),
        (1, 3, 1): ("invalid", 0), (1, 3, 2): ("invalid", 0), (1, 3, 3): ("repeated", 0), (1, 3, 4): ("invalid", None),
        (2, 0, 1): ("cyclic", None), (2, 0, 2): ("cyclic", None), (2, 0, 3): ("linked", 0), (2, 0, 4): ("unanswered", 1),
        (None, 1, 1): ("linked", 0),
    }
    assert got[1, 1, 2].json == '{"arguments":{"query":"é"},"id":"a","name":"search","result":{"x":[2],"y":1}}'
    assert got[1, 3, 1].problem == "argument query is no string" and got[1, 3, 2].problem == "unknown tool"
    assert got[1, 0, 0].json == '{"content":"hi \\"there\\"\\n","role":"user","turn":0}'
    assert got[None, 0, 0].json == '{"content":"","role":null,"turn":0}'
    assert sum(r.status == "message" for r in rows) == len(turns)
    for r in rows:
        assert json.dumps(json.loads(r.json), sort_keys=True, separators=(",", ":"), ensure_ascii=False) == r.json
    assert linked_chats(df.limit(0)).count() == 0


def test_pipeline_against_brute_force(spark):
    """Every stage on its own input: what it keeps, and that ids, texts and columns are right."""
    corpus = pytest.importorskip("corpus_pipeline")
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    stage = dict(corpus.STAGES)
    assert list(stage) == ["quality_rules", "near_dedup", "decontamination", "personal_data", "packing"]
    good = stage["quality_rules"](spark, docs, FOLDER)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    kept = {r.doc_id: r.text for r in good.collect()}
    assert not [i for i, q in labels.items() if q == 0 and i in kept]
    assert not [r.doc_id for r in docs.collect() if labels.get(r.doc_id) == 1 and r.doc_id not in kept and len(r.text.split()) >= 25]
    single = stage["near_dedup"](spark, good, FOLDER)
    ids = sorted(kept)
    _, root = near_brute([kept[i] for i in ids], 5, 80)
    assert sorted(r.doc_id for r in single.collect()) == [i for n, i in enumerate(ids) if root[n] == n]
    items = [r.text for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    clean = stage["decontamination"](spark, single, FOLDER)
    before = {r.doc_id: r.text for r in single.collect()}
    assert sorted(r.doc_id for r in clean.collect()) == sorted(i for i, t in before.items() if not any(x in t for x in items))
    safe = stage["personal_data"](spark, clean, FOLDER)
    assert good.columns == single.columns == clean.columns == safe.columns == docs.columns
    for r in safe.collect():
        assert "@mail" not in r.text and r.n_chars == len(r.text)
    last = stage["packing"](spark, safe, FOLDER).collect()
    assert {r.doc_id for r in last} == {r.doc_id for r in safe.collect()}
    assert sum(r.length for r in last) == sum({r.doc_id: r.doc_tokens for r in last}.values())


def test_pipeline_stages_on_edge_rows(spark):
    """Nulls, empty and very long texts, repeated rows, and columns named like the stages' own."""
    corpus = pytest.importorskip("corpus_pipeline")
    stage = dict(corpus.STAGES)
    good = prose(1, 60) + "\n" + prose(2, 40)
    long = " ".join(f"{w}{i % 4999}" for i, w in enumerate(prose(3, 20_000).split()))
    items = [r.text for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").limit(1).collect()]
    rows = [
        (None, good, None), (1, None, "a"), (2, "", "b"), (2, "", "b"), (3, " \n ", None), (4, good, "x"), (4, good, "x"), (5, good, "y"),
        (6, long, None), (7, prose(4, 90) + " " + items[0] + " " + prose(5, 90), "z"), (8, prose(6, 80) + " mail me at bob.x@mail.example.org now", "q"),
    ]
    ddl = "doc_id long, text string, rejected_by string, text_mark string, node string, component int, bucket long, spans int, w double, t string, sequence_id string"
    docs = spark.createDataFrame([(i, t, m, m, m, 1, 2, 3, 0.5, m, m) for i, t, m in rows], ddl)
    ids = lambda df: sorted((str(r.doc_id) for r in df.collect()))
    kept = stage["quality_rules"](spark, docs, FOLDER)
    assert ids(kept) == sorted(["None", "4", "4", "5", "6", "7", "8"])
    single = stage["near_dedup"](spark, docs, FOLDER)
    assert ids(single) == sorted(["1", "2", "2", "3", "4", "6", "7", "8"])
    clean = stage["decontamination"](spark, docs, FOLDER)
    assert ids(clean) == sorted(str(i) for i, _, _ in rows if i != 7)
    safe = stage["personal_data"](spark, docs, FOLDER)
    texts = {str(r.doc_id): r.text for r in safe.collect()}
    assert ids(safe) == sorted(str(i) for i, _, _ in rows) and texts["1"] is None and "[EMAIL]" in texts["8"] and texts["6"] == long
    packed_ = stage["packing"](spark, docs, FOLDER)
    assert {str(r.doc_id) for r in packed_.collect()} == {str(i) for i, _, _ in rows}
    assert kept.columns == single.columns == clean.columns == safe.columns == docs.columns
    for name, one in corpus.STAGES:
        out = one(spark, docs.limit(0), FOLDER)
        assert out.count() == 0 and (name == "packing" or out.columns == docs.columns)


def test_long_items_are_compared_a_few_stretches_at_once(spark, monkeypatch):
    """An item of thousands of words, whole in one text and changed in another."""
    item = prose(31, 5_000)
    words = item.split()
    changed = " ".join(w if i % 6 else "other" for i, w in enumerate(words))
    docs = spark.createDataFrame([(1, prose(32, 400) + " " + item + " " + prose(33, 90)), (2, changed), (3, prose(34, 6_000)), (4, None)], "doc_id long, text string")
    asked = spark.createDataFrame([(9, item), (10, "short one here")], "item_id long, text string")
    rows = {r.doc_id: (r.item_id, round(r.lcs_share, 2)) for r in leaks(docs, asked).collect()}
    assert rows == {1: (9, 1.0), 2: (9, 0.83)}


@pytest.mark.parametrize("together", [100_000, 2])
def test_steps_of_dependent_calls(spark, monkeypatch, together):
    """Chains, diamonds, circles and random dependencies, against a walk through them; also level by level."""
    monkeypatch.setattr(tools, "TOGETHER", together)
    r = random.Random(2)
    needs = {(1, f"c{i}"): [f"c{i - 1}"] if i else [] for i in range(5 if together == 2 else 300)}
    needs |= {(2, "a"): [], (2, "b"): ["a"], (2, "c"): ["a", "a"], (2, "d"): ["b", "c", "gone"], (2, "x"): ["y"], (2, "y"): ["x"], (2, "z"): ["y", "a"], (2, "s"): ["s"]}
    needs |= {(None, "a"): [], (None, "b"): ["a"], (3, "alone"): ["gone"]}
    for conv in range(4, 9):
        needs |= {(conv, f"n{i}"): [f"n{r.randint(0, 7)}" for _ in range(r.randint(0, 2))] for i in range(8)}

    def step(conv, call, above=()):
        if call in above:
            return None
        deep = [step(conv, n, (*above, call)) for n in needs[conv, call] if (conv, n) in needs]
        return None if None in deep else max((d + 1 for d in deep), default=0)

    rows = [(conv, call, n) for (conv, call), n in needs.items()]
    got = tools.call_steps(spark.createDataFrame(rows, "conv_id long, call_id string, needs array<string>")).collect()
    want = {(c, k): step(c, k) for c, k in needs if c != 1} | {(1, f"c{i}"): i for i in range(sum(c == 1 for c, _ in needs))}
    assert len(got) == len({(x.conv_id, x.call_id) for x in got})
    assert {(x.conv_id, x.call_id): x.step for x in got} == {k: v for k, v in want.items() if v is not None}
