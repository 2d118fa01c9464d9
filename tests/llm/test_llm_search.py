"""Repeats, near duplicates, revisits, search and page text against brute force."""

import hashlib
import html
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash
from conftest import SF
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from millrace.llm import QUERIES, mixing, simhash, suffix_dedup, topk, warc
from millrace.llm.html_text import Page
from millrace.llm.queries import QUALITY_SQL

LAST = 2**63 - 1


# Repeats


def removed_by_hand(docs, length=50):
    first, out = {}, []
    for doc_id, text in docs:
        data, key = (text or "").encode(), LAST if doc_id is None else doc_id
        for i in range(len(data) - length + 1):
            first[data[i : i + length]] = min(key, first.get(data[i : i + length], LAST))
    for doc_id, text in docs:
        data, key = (text or "").encode(), LAST if doc_id is None else doc_id
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            if first[data[i : i + length]] < key:
                gone[i : i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((doc_id, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def repeating_docs():
    rng = random.Random(5)
    letters = "ab é"
    docs = [(i if i % 9 else None, "".join(rng.choices(letters, k=rng.randint(0, 40))) * rng.randint(0, 8)) for i in range(60)]
    docs += [(3, "x" * 300), (4, "x" * 120), (4, "x" * 120), (5, None), (1, "é" * 80), (2, "aé" * 60), (6, "")]
    passage = "".join(rng.choices("abcdefghij é", k=400))
    for i in range(60):
        text = passage[rng.randint(0, 200) : rng.randint(200, 400)] + "".join(rng.choices(letters, k=30)) + passage[rng.randint(0, 300) :]
        docs.append((100 + i, text))
    return docs


@pytest.mark.parametrize(
    "limits", [{}, {"block_bytes": 2000, "bucket_bytes": 1500}, {"block_bytes": 1000, "bucket_bytes": 3000, "hot_blocks": 1}]
)
def test_repeats(spark, limits):
    docs = repeating_docs()
    df = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("row", F.lit(1)).withColumn("block", F.lit(2)).repartition(5)
    marks = suffix_dedup.remove_repeats(df, **limits).select("id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert Counter(tuple(r) for r in marks.collect()) == removed_by_hand(docs)


@pytest.mark.parametrize("length", [2, 5, 9, 30])
def test_repeats_of_other_lengths(spark, length):
    docs = [(i, t and t[:60]) for i, t in repeating_docs()]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    marks = suffix_dedup.remove_repeats(df, length).select("id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert Counter(tuple(r) for r in marks.collect()) == removed_by_hand(docs, length)


def test_repeats_of_the_documents(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = Counter(tuple(r) for r in QUERIES["op2_run_index_dedup"](spark, SF).collect())
    assert got == removed_by_hand(docs)


def test_repeats_keep_whole_characters_and_rows(spark):
    head = "".join(chr(0xE0 + i % 30) for i in range(60))
    docs = [(1, head, "a"), (2, "xé" + head[1:], "b"), (3, "è" + head[1:] + "tail", None)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, _id string")
    rows = {r.id: r for r in suffix_dedup.remove_repeats(df, carry=True).collect()}
    assert rows[1].kept == head and rows[1].n_removed == 0 and rows[3].row["_id"] is None
    # The last byte of the letter before the passage equals the passage's, half a letter goes, the letter stays.
    assert rows[2].kept == "xé" and rows[3].kept == "ètail"
    assert [tuple(s) for s in rows[3].spans] == [(1, 2 + 118)] or rows[3].n_spans == 1
    assert suffix_dedup.remove_repeats(df.limit(0)).count() == 0


def test_a_common_line_is_dealt_over_the_buckets(spark):
    """One line of 40 bytes in every document, each time with other neighbours, fills no part of a bucket."""
    import pyarrow as pa

    rng = random.Random(7)
    line = "This is the line that all of them share."
    docs = [(i, "".join(rng.choices("abcdefgh", k=40)) + line + "".join(rng.choices("abcdefgh", k=40))) for i in range(3000)]
    docs += [(3000 + i, docs[i][1]) for i in range(0, 3000, 100)] + [(5000, line), (5001, docs[5][1][20:100])]
    bucket_bytes, buckets = 20_000, 20
    schema = pa.schema([("_id", pa.int64()), ("_text", pa.binary())])
    rows = []
    for number in range(0, len(docs), 1000):
        some = docs[number : number + 1000]
        table = pa.table([[d for d, _ in some], [t.encode() for _, t in some]], schema=schema)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, schema) as writer:
            writer.write_table(table)
        rows.append((number, sink.getvalue().to_pybytes()))
    blocks = pa.table([[n for n, _ in rows], [d for _, d in rows]], names=["block", "data"])
    tags = pa.Table.from_batches(suffix_dedup._anchor_rows(50, buckets)(iter(blocks.to_batches())))
    judge = suffix_dedup._shared_anchors(50, suffix_dedup.HOT_BLOCKS, bucket_bytes)
    answers = pa.concat_tables(judge(tags.filter(pa.compute.equal(tags["bucket"], b))) for b in set(tags["bucket"].to_pylist()))
    held = Counter()
    for number, _ in rows:
        of = [t.filter(pa.compute.equal(t["block"], number)) for t in (blocks, answers)]
        for r in suffix_dedup._segment_rows(50, buckets)(*of).to_pylist():
            for size, part in zip(np.frombuffer(r["sizes"], np.uint16).tolist(), r["parts"]):
                held[r["bucket"], part] += size
    assert sum(held.values()) > 3000 * 60 and max(held.values()) < 2 * bucket_bytes
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4)
    marks = suffix_dedup.remove_repeats(df, bucket_bytes=bucket_bytes).select("id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert Counter(tuple(r) for r in marks.collect()) == removed_by_hand(docs)


def test_copies_do_not_make_an_anchor_hot():
    block = suffix_dedup.Block([b"0123456789 abcdefghij klmnopqrst uvwxyz 0123456789 and so on"] * 500, 50)
    hashes, _, _, place = block.anchors(3)
    assert block.loads(place, len(hashes)).tolist() == [0] * len(hashes)


@pytest.mark.parametrize("segments", [1, 64])
def test_an_anchor_of_many_blocks_is_hot_by_its_bytes_alone(segments):
    """1500 blocks with one segment of an anchor each send 121 KB for it; only with 64 each they fill more than a bucket."""
    import pyarrow as pa

    n, load = 1500, bytes([segments.bit_length() - 1])
    tag = np.array([5 << 1], dtype=np.uint32).tobytes()
    table = pa.table({"bucket": [0] * n, "block": list(range(n)), "tags": [tag] * n, "loads": [load] * n})
    told = suffix_dedup._shared_anchors(50, suffix_dedup.HOT_BLOCKS, suffix_dedup.BUCKET_BYTES)(table).to_pylist()
    assert [r["block"] for r in told] == list(range(n)) and {r["shared"] for r in told} == {b"\x80"}
    assert {r["hot"] for r in told} == {b"\x80" if segments == 64 else b"\x00"}


def test_answers_of_many_lists_are_those_of_each_list(monkeypatch):
    rng = np.random.default_rng(3)
    windows = rng.integers(1, 5, 40)
    begins = np.cumsum(windows) - windows
    first = rng.integers(0, 3, int(windows.sum()))
    lists = [rng.integers(0, 40, int(k)) for k in rng.integers(1, 30, 50)]
    for together in (1, 37, 1 << 14):
        monkeypatch.setattr(suffix_dedup, "ANSWER_SEGMENTS", together)
        ids, runs = suffix_dedup._answers(lists, windows, begins, first)
        assert len(ids) == len(runs) == 50
        for mine, values, times in zip(lists, ids, runs):
            expected = np.concatenate([first[begins[i] : begins[i] + windows[i]] for i in mine])
            values = np.frombuffer(values, np.int64)
            assert np.array_equal(np.repeat(values, np.frombuffer(times, np.int32)), expected) and (np.diff(values) != 0).all()


def test_run_index_finds_every_context():
    rng = random.Random(1)
    pieces = list({"".join(rng.choices("abc", k=rng.randint(8, 20))).encode() for _ in range(200)})
    ids = np.arange(len(pieces))
    index = suffix_dedup.RunIndex(pieces, ids, 8)
    found, begins = index.first_ids()
    for piece, begin in zip(pieces, begins.tolist()):
        for i in range(len(piece) - 7):
            expected = min(k for k, other in enumerate(pieces) if piece[i : i + 8] in other)
            assert found[begin + i] == expected
    assert len(index.run_first) < index.rows


# Near duplicates


def groups_by_hand(docs, shingle, bits):
    prints = []
    for _, text in docs:
        words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
        pieces = [b" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))] if words else []
        hashes = [xxhash.xxh64_intdigest(p, 42) for p in pieces]
        prints.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)))
    group = list(range(len(docs)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    codes = np.array(prints, dtype=np.uint64)
    for i in range(len(docs)):
        for j in np.flatnonzero(np.bitwise_count(codes[i + 1 :] ^ codes[i]) <= bits).tolist():
            group[root(i + 1 + j)] = root(i)
    least = {}
    for i, (doc_id, _) in enumerate(docs):
        if doc_id is not None:
            least[root(i)] = min(doc_id, least.get(root(i), LAST))
    return Counter((d, f"{p:016x}", least.get(root(i))) for i, ((d, _), p) in enumerate(zip(docs, prints)))


@pytest.mark.parametrize("limits", [{}, {"bucket_nodes": 40, "group_nodes": 2}])
def test_near_groups(spark, limits):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    docs += [(None, None), (5000, ""), (5001, " \n "), (5002, "One"), (5002, "one"), (5003, "one TWO"), (None, "alone here it is")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("h", F.lit("x")).withColumn("id", F.lit("y"))
    got = Counter(tuple(r) for r in simhash.near_groups(df, 3, 2, **limits).collect())
    assert got == groups_by_hand(docs, 3, 2)
    assert simhash.near_groups(df.limit(0)).count() == 0


def test_tree_join_finds_all_pairs():
    rng = np.random.default_rng(0)
    codes = rng.integers(0, 2**63, 100, dtype=np.uint64)
    for _ in range(3):
        codes = np.concatenate([codes, codes ^ (np.uint64(1) << rng.integers(0, 64, len(codes)).astype(np.uint64))])
    for bits in (0, 1, 2, 3):
        sorted_codes, a, b = simhash.close_pairs(codes, bits)
        apart = np.bitwise_count(sorted_codes[:, None] ^ sorted_codes[None, :])
        expected = np.argwhere(np.triu(apart <= bits, 1))
        assert {*zip(a.tolist(), b.tolist())} == {*map(tuple, expected.tolist())}


def test_components_of_a_long_chain(spark):
    edges = spark.range(200).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"))
    got = {r.u: r.root for r in simhash.components(edges).collect()}
    assert got == {i: 0 for i in range(1, 201)}


def test_representatives_keep_one_row_of_each_group(spark):
    rows = [(1, "a b c d", "x"), (2, "A b c D", "y"), (2, "A b c D", "y"), (3, "other words stand here", None), (None, None, "z"), (9, "", "z")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, key string")
    got = Counter(tuple(r) for r in simhash.representatives(df).collect())
    assert sum(got.values()) == 3 and got[(1, "a b c d", "x")] == 1 and got[(3, "other words stand here", None)] == 1


# Revisits


def test_revisits(spark):
    rng = random.Random(2)
    records = []
    for i in range(400):
        url = rng.choice(["http://hot.example/a", "https://www.HOT.example:443/a/?utm_source=q#x", "http://b.example/?z=1&a=2", None, ""])
        if rng.random() < 0.5:
            headers = {"ETag": f'"{rng.randint(0, 2)}"', "Content-Type": "t", "Vary": "old"} if rng.random() < 0.9 else None
            records.append((i, "response", url, rng.randint(0, 120), rng.choice([200, 200, 404, None]), headers, rng.choice(["p", "q", None])))
        else:
            headers = rng.choice([{"etag": f'W/"{rng.randint(0, 2)}"', "vary": "new", "content-type": "no"}, {"Last-Modified": "m"}, {}, None])
            records.append((i, "revisit", url, rng.choice([rng.randint(0, 120), rng.randint(0, 120), None]), 304, headers, None))
    records.append(records[0])
    types = "record_id bigint, kind string, url string, captured_at bigint, status int, headers map<string,string>, payload string"
    df = spark.createDataFrame(records, types).withColumn("_slice", F.lit("x"))
    canonical = {
        "http://hot.example/a": "hot.example/a", "https://www.HOT.example:443/a/?utm_source=q#x": "hot.example/a",
        "http://b.example/?z=1&a=2": "b.example?a=2&z=1", "": "", None: None,
    }
    expected = []
    for number, kind, url, at, status, headers, payload in records:
        key, own = canonical[url], {k.lower(): v for k, v in (headers or {}).items()}
        full = kind == "response" and status == 200 and payload is not None
        if key is None or kind == "response":
            outcome = "no_url" if key is None else "full" if full else "no_payload"
            expected.append((number, outcome, number if outcome == "full" else None, own.get("vary"), own.get("content-type")))
            continue
        earlier = [
            r for r in records
            if at is not None and canonical[r[2]] == key and r[1] == "response" and r[4] == 200 and r[6] is not None and r[3] < at
        ]
        if not earlier:
            outcome, old = "no_earlier_response", None
        else:
            old = max(earlier, key=lambda r: (r[3], r[0]))
            stored = {k.lower(): v for k, v in (old[5] or {}).items()}
            if "etag" in own:
                outcome = "resolved" if own["etag"].removeprefix("W/") == stored.get("etag") else "validator_mismatch"
            else:
                outcome = "validator_mismatch" if "last-modified" in own else "no_validator"
        if outcome == "resolved":
            expected.append((number, outcome, old[0], "new", stored.get("content-type")))
        else:
            expected.append((number, outcome, None, own.get("vary"), own.get("content-type")))
    for slice_rows in (7, 16_384):
        rows = warc.resolve_revisits(df, slice_rows)
        got = rows.select("record_id", "outcome", "response_id", F.col("headers")["vary"], F.col("headers")["content-type"]).collect()
        assert Counter(map(tuple, got)) == Counter(expected)
    assert {r[1] for r in expected} == {
        "full", "no_payload", "no_url", "resolved", "validator_mismatch", "no_validator", "no_earlier_response",
    }
    assert warc.resolve_revisits(df.limit(0)).count() == 0


REVISITS_SQL = """
SELECT v.record_id, CASE WHEN r.record_id IS NULL THEN 'no_earlier_response' WHEN v.etag IS NULL THEN 'no_validator'
         WHEN v.etag = r.etag THEN 'resolved' ELSE 'validator_mismatch' END AS outcome,
       CASE WHEN v.etag = r.etag THEN r.record_id END AS response_id
FROM (SELECT * FROM records WHERE kind = 'revisit') v
ASOF LEFT JOIN (
  SELECT url, captured_at, max(record_id) AS record_id, arg_max({'e': etag}, record_id).e AS etag FROM records WHERE kind = 'response' GROUP BY ALL
) r ON v.url = r.url AND v.captured_at > r.captured_at
"""


@pytest.mark.parametrize("slice_rows", [300, 16_384])
def test_revisits_of_urls_with_many_responses(spark, tmp_path, slice_rows):
    """URLs of the pages with responses and revisits before, between and long after them; one holds a third of all."""
    import duckdb

    # Host and first part of the path, as the operator's canonical form has them.
    place = F.regexp_extract(F.lower("url"), r"^[a-z]+://(?:www[0-9]*\.)?([^/?#:]+(?:/[^/?#]+)?)", 1)
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", F.concat(F.lit("http://"), place).alias("u"))
    step = pages.crossJoin(spark.range(60)).select("u", (F.col("page_id") * 60 + F.col("id")).alias("record_id"))
    draw = [F.pmod(F.xxhash64("record_id", F.lit(i)), F.lit(n)) for i, n in enumerate((3, 5, 4000, 3))]
    records = step.select(
        "record_id",
        F.when(draw[0] == 0, "http://hot.example/a").otherwise(F.col("u")).alias("url"),
        # Times before 100 have revisits only, and few responses come after 3000.
        F.when((draw[2] >= 100) & (draw[1] == 0) & ((draw[2] < 3000) | (draw[3] == 0)), "response").otherwise("revisit").alias("kind"),
        draw[2].alias("captured_at"),
        F.when(draw[3] < 2, F.concat(F.lit('"'), draw[3].cast("string"), F.lit('"'))).alias("etag"),
    )
    path = str(tmp_path / "records")
    records.write.parquet(path)
    records = spark.read.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW records AS SELECT * FROM '{path}/*.parquet'")
    expected = Counter(con.sql(REVISITS_SQL).fetchall())
    response = F.col("kind") == "response"
    tags = F.when(F.col("etag").isNotNull(), F.create_map(F.lit("ETag"), F.col("etag"))).otherwise(F.create_map().cast("map<string,string>"))
    full = records.select(
        "record_id", "kind", "url", "captured_at", F.when(response, 200).otherwise(304).alias("status"), tags.alias("headers"),
        F.when(response, F.col("record_id").cast("string")).alias("payload"),
    )
    got = warc.resolve_revisits(full, slice_rows).where("outcome not in ('full')")
    assert Counter(map(tuple, got.select("record_id", "outcome", "response_id").collect())) == expected
    outcomes = Counter(o for _, o, _ in expected)
    assert len(outcomes) == 4 and outcomes["resolved"] > 1000 and outcomes["no_earlier_response"] > 100


# Search


def top_by_hand(rows, k):
    whole = []
    for number, (vec_id, vector) in enumerate(rows):
        if vec_id is not None and vector is not None and all(x is not None and np.isfinite(x) for x in vector):
            whole.append((number, vec_id, [int(np.floor(256 * float(x))) for x in vector]))
    out = []
    for number, vec_id, q in whole:
        if vec_id % 50 == 0:
            scores = [(-sum(a * b for a, b in zip(q, c)), i, n) for n, i, c in whole if n != number and len(c) == len(q)]
            out += [(vec_id, r + 1, i, -s) for r, (s, i, _) in enumerate(sorted(scores)[:k])]
    return Counter(out)


@pytest.mark.parametrize("sizes", [{}, {"query_tile": 3, "shard_rows": 10, "fan_in": 2}])
def test_top_k(spark, sizes):
    rng = random.Random(6)
    rows = [(i, [float(rng.randint(-2, 2)) / 4 for _ in range(4)]) for i in range(200)]
    rows += [(i, [0.5, 0.5, 0.5, 0.5]) for i in range(200, 300)]
    rows += [(300, None), (301, [1.0, None, 0.0, 0.0]), (350, [1.0, float("nan"), 0.0, 0.0]), (351, [float("inf"), 0.0, 0.0, 0.0])]
    rows += [(400, [1.0, 2.0]), (401, [3.0, 4.0]), (450, []), (None, [0.1] * 4), (50, [0.25] * 4), (50, [0.25] * 4)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("row", F.lit("x")).withColumn("dim", F.lit("y"))
    got = topk.top_k(df, F.col("id") % 50 == 0, 5, 256, **sizes)
    assert Counter(tuple(r) for r in got.collect()) == top_by_hand(rows, 5)
    assert topk.top_k(df.limit(0), F.col("id") % 50 == 0, 5, 256).count() == 0


def test_top_k_gathers_queries_whatever_the_partitions(spark):
    rows = spark.range(4000).selectExpr("id AS vec_id", "array(CAST(id % 7 AS FLOAT), CAST(id % 11 AS FLOAT)) AS embedding")
    expected = None
    for parts in (1, 40):
        df = rows.repartition(parts)
        vectors = topk.whole_vectors(df, "vec_id", "embedding", 1)
        sizes = [r.n for r in topk.packed(vectors.where("id % 50 = 0").repartition(1), 4096).collect()]
        assert sizes == [80]
        shards = topk.packed(vectors, 300).collect()
        assert max(r.n for r in shards) <= 300 and sum(r.n for r in shards) == 4000 and len(shards) <= 14 + parts
        assert all(len(r.vectors) == 2 * r.n for r in shards)  # one byte is enough for each component
        plan = topk.top_k(df, F.col("id") % 50 == 0, 5, 1)
        assert "SinglePartition" not in plan._jdf.queryExecution().executedPlan().toString()
        got = Counter(tuple(r) for r in plan.collect())
        assert expected is None or got == expected
        expected = got


def test_top_k_of_large_components(spark):
    rows = [(i, [float(1 << (18 + i)), -float(i)]) for i in range(8)] + [(50, [3e6, 1.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = topk.top_k(df, F.col("id") % 50 == 0, 5, 256)
    assert Counter(tuple(r) for r in got.collect()) == top_by_hand(rows, 5)


# Pages


def test_pages_give_their_articles(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = {r.page_id: r for r in QUERIES["op10_html_main_text"](spark, SF).collect()}
    assert got.keys() == pages.keys()
    for page_id, source in pages.items():
        article = re.search(r"<article>(.*?)</article>", source, re.S)[1]
        blocks = [re.sub(r"<br>", " ", b) for b in re.split(r"</?(?:p|h1)>", article)]
        blocks = [" ".join(html.unescape(re.sub(r"</?b>", "", b)).split()) for b in blocks]
        assert got[page_id].text == "\n\n".join(b for b in blocks if b)
        assert got[page_id].n_chars == len(got[page_id].text)


@pytest.mark.parametrize(
    ("source", "text"),
    [
        ("", ""),
        ("no tags at all", "no tags at all"),
        ("<p>a &amp;amp; b&nbsp;c<p>d<br>e", "a &amp; b c\n\nd e"),
        ("<body><nav>x</nav><div class=post><p>One <b>two<p>three</div><footer>y</footer>", "One two\n\nthree"),
        ("<article><h1>T</h1><p>a</p><section class='comments'><p>no</p></section><ul><li>x<li>y</ul></article>", "T\n\na\n\nx\n\ny"),
        ("<main><p>long text of it</p><aside>no</aside><form><p>no</p></form><p>more</p></main>", "long text of it\n\nmore"),
        ("<article><script>var a='</p><p>no';</script><style>p{}</style><p>yes<!-- <p>no</p> --></p></article>", "yes"),
        ("<article><p title='a>b' data-x=\"<p>\">in</p></article><div class='cookie-notice'><p>no no no no</p></div>", "in"),
        ("<article><p>cut off <a href='x", "cut off"),
        ("<div><p>1 < 2 and 3 > 2</p></div>", "1 < 2 and 3 > 2"),
        ("<header><h1>Site</h1></header><article><header><h1>Title</h1></header><p>b</p></article>", "Title\n\nb"),
        ("<article><p>a</p></article><div role=navigation><p>menu menu menu</p></div><div hidden><p>no</p></div>", "a"),
        ("<ARTICLE><P>Upper</P></ARTICLE></div></p>", "Upper"),
        ("<table><tr><td>a b<td>c d</table>", "a b\n\nc d"),
    ],
)
def test_page_text(source, text):
    page = Page(source)
    assert page.extract(None) == text


@pytest.mark.parametrize(
    ("source", "text"),
    [
        ("<article><p>a <a href='/hidden-gems'>word</a> b</p></article>", "a word b"),
        ("<article><p title='hidden costs'>a</p><p>b</p></article>", "a\n\nb"),
        ("<article><section data-url='/hidden/1'><p>a</p></section><p data-state=hidden>b</p></article>", "a\n\nb"),
        ("<div data-hidden='false' data-role='menu'><p>a</p></div>", "a"),
        ("<div data-id='comment-7'><article><p>a</p></article></div>", "a"),
        ("<article><p>a</p><p hidden>no</p><p HIDDEN>no</p><p aria-hidden='true'>no</p><p class=x hidden=''>no</p></article>", "a"),
        ("<article><p>some text</p><div id = 'comments'>no</div><div title='x' role=menu>no</div><p style='display: none'>no</p></article>", "some text"),
    ],
)
def test_attributes_by_their_full_names(source, text):
    assert Page(source).extract(None) == text


@pytest.mark.parametrize(
    "wrapper",
    [
        "div class='layout has-sidebar'", "div class='content-sidebar-wrap'", "div id='page' class='no-sidebar menu-closed'",
        "article class='post comments-open'", "div class='has-header'", "div class=widget", "div id=comments class='share'", "section class='promo'",
    ],
)
@pytest.mark.parametrize("inner", ["<article><p>one two</p></article>", "<p>one two</p>", "<div><p>one</p><p>two</p></div>"])
def test_wrappers_with_words_of_notices_pass(wrapper, inner):
    end = wrapper.split()[0]
    source = f"<body><{wrapper}>{inner}<div class='ad'>x</div></{end}><div class='site-footer'>y</div></body>"
    assert Page(source).extract(None).split() == ["one", "two"]


@pytest.mark.parametrize(
    ("source", "text"),
    [
        ("<article><p>a</p><section class='social-history'><p>b</p></section><div class='related-work'>c</div></article>", "a\n\nb\n\nc"),
        ("<article><p>a b c</p><div class='comment-list'><article class='comment'>no</article></div></article>", "a b c"),
        ("<article><p>a b <span class='ad'>no <span>no</span></span> c</p></article>", "a b c"),
        ("<div><p><span class='banner'>all of <b>the</b> text</span></p></div>", "all of the text"),
        ("<div><div class='widget'>one</div><div class='widget'>two</div></div>", "one\n\ntwo"),
        ("<div class='site-header'><p>no</p></div><div class='shareButtons'>no</div><div><p>the text</p></div>", "the text"),
    ],
)
def test_class_words_are_judged_whole(source, text):
    assert Page(source).extract(None) == text


LONG = " ".join(["long"] * 40)


@pytest.mark.parametrize(
    ("source", "text"),
    [
        ("<div class='post'><h1>T</h1><p>lead</p><div class='entry'>{}</div></div>", "T\n\nlead\n\n{}"),
        ("<body><h1>T</h1><p>lead</p><div>{}</div></body>", "T\n\nlead\n\n{}"),
        ("<div><div><h1>T</h1></div><div><p>lead</p></div><div><div>{}</div></div></div>", "T\n\nlead\n\n{}"),
        ("<div class=post><p>a</p><section>{}</section><section><p>b</p></section></div>", "a\n\n{}\n\nb"),
        ("<article><p>a</p><table><tr><td>{}<td>b</table><p>c</p><a href=x>links of it</a></article>", "a\n\n{}\n\nb\n\nc\n\nlinks of it"),
        ("<div><p>a</p><blockquote><p>{}</p></blockquote><p>b <a href=x>links links</a></p></div>", "a\n\n{}\n\nb links links"),
        ("<table><tr><td><a href=x>menu and more menu</a><td><h1>T</h1>{}</table>", "T\n\n{}"),
        ("<div class=post><h1>T</h1><article>{}</article></div><p>Copyright</p>", "T\n\n{}"),
        ("<body><p>x</p><article><div><p>a</p><div>{}</div></div></article><p>Copyright</p></body>", "a\n\n{}"),
        ("<body><div class=text><p>{}</p></div><div class=b><p>apart</p></div></body>", "{}"),
    ],
)
def test_text_beside_the_body_is_kept(source, text):
    assert Page(source.format(LONG)).extract(None) == text.format(LONG)


@pytest.mark.parametrize(
    ("source", "text"),
    [
        # A comment that ends at once.
        ("<p>a</p><!--><p>b</p><!---><p>c</p><!-- <p>no</p> --!><p>d</p><!-- x", "a\n\nb\n\nc\n\nd"),
        # Inline elements are judged like others, and end with the block they stand in.
        ("<article><p>a <a style='display:none' href=x>no</a>b <ins class='ad'>no</ins>c <a class='sponsored' href=y>no</a>d</p></article>", "a b c d"),
        ("<article><p>a <ins class=ad>no<p>b</p><p>c <span hidden>no <b>no</b></span> d</p></article>", "a\n\nb\n\nc d"),
        ("<article><p>a <a name=top>b</a> c</p></article>", "a b c"),
        # What stands within a block does not tear it.
        ("<article><p>a <script>no</script>b <svg><text>no</text></svg>c <button>no</button> d <input value=no>e</p></article>", "a b c d e"),
        ("<article><p>a <noscript><div>no</div></noscript>b <picture><source><img></picture>c <my-tip>d</my-tip> e</p></article>", "a b c d e"),
        ("<article><p>a <ruby>b<rp>(</rp><rt>c</rt><rp>)</rp></ruby> <math><mi>x</mi><mo>=</mo><mn>1</mn></math> d<wbr>e</p></article>", "a b(c) x=1 de"),
        ("<article><p>a <select><option>no</select> b <textarea>no</textarea> c<hr>d</article>", "a b c\n\nd"),
        # Tables that lay out the page.
        ("<body><table><tr><td><ul><li>menu<li>more</ul></td><td><p>{}</p><p>end</p></td><td>side</td></tr></table>", "{}\n\nend"),
        ("<table><tr><td colspan=3>top</td></tr><tr><td>menu</td><td><h1>T</h1><p>{}</p></td><td>side side</td></tr></table>", "T\n\n{}"),
        ("<div><p>{}</p><table><tr><td>1</td><td>2</td></tr></table><p>b</p></div>", "{}\n\n1\n\n2\n\nb"),
    ],
)
def test_ordinary_pages(source, text):
    assert Page(source.replace("{}", LONG)).extract(None) == text.replace("{}", LONG)


@pytest.mark.parametrize(
    "name",
    "related-posts post-comments user-comments ad-slot google-ads main-nav primary-menu cookie-message share-this newsletter-form "
    "relatedPosts article-sidebar social-share-buttons entry-comments-list adUnit promo-module".split(),
)
@pytest.mark.parametrize("kind", ["class", "id"])
def test_names_are_judged_by_their_head(name, kind):
    source = f"<body><div class='post'><p>{LONG}</p><div {kind}='{name}'><p>no such text</p></div><p>end of it</p></div></body>"
    assert Page(source).extract(None) == f"{LONG}\n\nend of it"


@pytest.mark.parametrize("name", "has-sidebar menu-closed comments-open social-history related-work no-ads adventure advice commentary".split())
def test_other_names_pass(name):
    source = f"<body><div class='post'><p>{LONG}</p><div class='{name}'><p>some more text</p></div></div></body>"
    assert Page(source).extract(None) == f"{LONG}\n\nsome more text"


def test_links_under_a_doubtful_name_go():
    links = "".join(f"<li><a href='/{i}'>another story {i}</a></li>" for i in range(5))
    for name, left in (("promo-cards-grid", ""), ("cards-grid", "1")):
        source = f"<body><div class='post'><p>{LONG}</p><div class='{name}'><ul>{links}</ul></div><p>end</p></div></body>"
        assert ("another story" in Page(source).extract(None)) == bool(left)


@pytest.mark.parametrize("kind", ["div", "div class=col"])
def test_the_winning_path_takes_one_element(spark, kind):
    """All parts of a page have the same path; the article alone is taken, on pages that vote and on one that differs."""
    from millrace.llm.html_text import extract_pages

    end = kind.split()[0]
    page = f"<body><div><{kind}>menu of it</{end}><{kind}><p>{{}}</p><p>second</p></{end}><{kind}>teasers and so on</{end}></div></body>"
    rows = [(i, "http://a.example/x", page.format(f"{LONG} {i}")) for i in range(4)]
    rows.append((9, "http://a.example/y", f"<body><div><{kind}><p>{LONG}</p></{end}></div></body>"))
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = {r.page_id: r.text for r in extract_pages(df).collect()}
    assert got == {i: f"{LONG} {i}\n\nsecond" for i in range(4)} | {9: LONG}


DEEP = {
    "nested": lambda n: "<div>" * n + "text" + "</div>" * n,
    "text at each level": lambda n: "".join(f"<div class='c{i % 7}'>word {i} " for i in range(n)),
    "stray ends": lambda n: "<div>" * n + "x" + "</p>" * n + "</li>" * n + "</span>" * n,
    "cells": lambda n: "<div>" * n + "<td>y" * n,
    "lists": lambda n: "<ul><li>z" * n,
    "suspects": lambda n: "<span class=ad>" * n + "q",
    "beside the text": lambda n: "<div>" + "<div>w" * n + "</div>" * n + "<div><p>" + LONG + "</p></div></div>",
}


@pytest.mark.parametrize("kind", DEEP)
def test_deep_pages_cost_in_proportion(kind):
    """200,000 nested tags, in a process of its own."""
    import inspect
    import os
    import subprocess
    import sys

    body = inspect.getsource(DEEP[kind]).split("lambda n: ", 1)[1].rstrip().rstrip(",")
    code = (
        "import resource\nfrom millrace.llm.html_text import Page\n"
        f"LONG = {LONG!r}\nn = 200_000\npage = Page({body})\nbest = page.best()\npage.extract(best.path())\n"
        "print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024)"
    )
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=60, cwd=root, check=True)
    assert int(done.stdout) < 500


def test_hosts_vote_for_the_whole_text(spark):
    from millrace.llm.html_text import extract_pages

    page = "<div class='post'>{}<div class='entry'><p>{}</p></div></div><div class='b'>apart</div>"
    rows = [(i, "http://a.example", page.format("<h1>T</h1><p>lead</p>" if i < 2 else "", LONG)) for i in range(5)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    assert {r.page_id: r.text for r in extract_pages(df).collect()} == {i: f"T\n\nlead\n\n{LONG}" if i < 2 else LONG for i in range(5)}


def test_hosts_agree_on_a_path(spark):
    """A page whose advert is longer than its article follows the other pages of its host."""
    from millrace.llm.html_text import extract_pages

    usual = "<body><div class='text'><p>{}</p></div><div class='b{}'><p>short</p></div></body>"
    rows = [(i, f"https://Host.example/{i}", usual.format("word " * 30, i)) for i in range(5)]
    rows += [(9, "http://host.example/9", usual.format("few words", 9).replace("short", "promo " * 60))]
    rows += [(10, None, None), (11, "x", ""), (12, "https://other.example", "<p>alone</p>"), (0, *rows[0][1:])]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("path", F.lit(1)).withColumn("host", F.lit(2))
    got = Counter((r.page_id, r.text, r.n_chars) for r in extract_pages(df).collect())
    words = " ".join(["word"] * 30)
    expected = [(i, words, len(words)) for i in (0, 0, 1, 2, 3, 4)]
    expected += [(9, "few words", 9), (10, "", 0), (11, "", 0), (12, "alone", 5)]
    assert got == Counter(expected)
    assert extract_pages(df.limit(0)).count() == 0


# The pipeline


def test_pipeline_stage_by_stage(spark):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    start = spark.read.parquet(f"{SF}/documents.parquet")
    docs, columns = start, start.columns
    after = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF).cache()
        after[name] = docs.collect()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    kept = {r[0] for r in con.sql(QUALITY_SQL).fetchall() if r[-1]}
    first = after["quality_rules"]
    assert {r.doc_id for r in first} == kept and len(first) == len(kept)
    groups = groups_by_hand([(r.doc_id, r.text) for r in first], 3, 2)
    second = after["simhash_near_dedup"]
    assert Counter(r.doc_id for r in second) == Counter({g for _, _, g in groups})
    marks = {m[0]: m for m in removed_by_hand([(r.doc_id, r.text) for r in second])}
    third = {r.doc_id: r.text for r in after["suffix_array_dedup"]}
    before = {r.doc_id: r.text for r in second}
    for doc_id, text in before.items():
        if marks[doc_id][2] == 0:
            assert third[doc_id] == text
        elif doc_id in third:
            left = marks[doc_id][1] - marks[doc_id][2]
            assert left <= len(third[doc_id].encode()) <= left + 6 * marks[doc_id][3]
    fourth = after["mixing_sources"]
    uses = Counter(r.doc_id for r in fourth)
    assert uses.keys() <= third.keys() and max(uses.values()) <= 2
    assert all(r.n_chars == len(r.text) for r in fourth)
    last = after["best_fit_packing"]
    assert Counter(r.doc_id for r in last if r.piece == 0) == uses
    filled = Counter()
    for r in sorted(last, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == filled[r.sequence_id]  # no gap and no overlap
        filled[r.sequence_id] += r.length
    assert max(filled.values()) <= 1024 and len(filled) <= -(-sum(filled.values()) // 1024) * 1.02


def kept_by_hand(docs, length=50):
    """What is left of each text if a character goes with all its bytes; documents left without a word go."""
    first, out = {}, {}
    for doc_id, text in docs:
        data = text.encode()
        for i in range(len(data) - length + 1):
            first[data[i : i + length]] = min(doc_id, first.get(data[i : i + length], LAST))
    for doc_id, text in docs:
        data = text.encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            if first[data[i : i + length]] < doc_id:
                gone[i : i + length] = b"\1" * length
        left, at = [], 0
        for letter in text:
            size = len(letter.encode())
            if not all(gone[at : at + size]):
                left.append(letter)
            at += size
        left = "".join(left)
        if not any(gone) or re.search(r"[^\x20\x09-\x0D]", left):
            out[doc_id] = left
    return out


def test_pipeline_stages_by_hand(spark):
    """Stage 3 by its texts and the documents it drops, stage 4 by its words, stage 5 with the tokenizer itself."""
    docs, after = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        if name == "suffix_array_dedup":
            # Parts of a document that stage 2 has kept, under ids of their own, so that stage 3 has one to drop.
            long = docs.orderBy("doc_id").first().text
            parts = spark.createDataFrame([(10**9, long[100:400]), (10**9 + 1, long[:200] + " and more of it")], "doc_id bigint, text string")
            docs = docs.unionByName(parts, allowMissingColumns=True).cache()
            after["before"] = docs.collect()
        docs = stage(spark, docs, SF).cache()
        after[name] = docs
    third = after["suffix_array_dedup"].collect()
    assert len({r.doc_id for r in after["before"]}) == len(after["before"])
    expected = kept_by_hand([(r.doc_id, r.text) for r in after["before"]])
    assert {r.doc_id: r.text for r in third} == expected and len(third) == len(expected) < len(after["before"])
    assert any(r.text != expected.get(r.doc_id, r.text) for r in after["before"])

    word = re.compile(r"[^\x20\x09-\x0D]+")
    taken = {r.doc_id: r.taken for r in mixing.taken(after["suffix_array_dedup"]).collect()}
    words = {}
    fourth = after["mixing_sources"].collect()
    for r in fourth:
        words.setdefault(r.doc_id, Counter()).update(word.findall(r.text))
    assert {d: sum(c.values()) for d, c in words.items()} == {d: n for d, n in taken.items() if n}
    for doc_id, used in words.items():
        own = Counter(word.findall(expected[doc_id]))
        assert all(n <= 2 * own[w] for w, n in used.items())

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = Counter()
    for r in fourth:
        ids = np.array([*tokenizer.encode(r.text, add_special_tokens=False).ids, 2], dtype="<u4")
        starts = [0, *range(len(ids) % 1024 or 1024, len(ids), 1024)]
        for piece, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)])):
            pieces[r.doc_id, piece, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    last = after["best_fit_packing"].collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in last) == pieces
    places = {}
    for r in last:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for of in places.values():
        end = 0
        for offset, size in sorted(of):
            assert offset == end
            end += size
        assert end <= 1024


def test_pipeline_leaves_its_result_alone(spark):
    import os

    folder = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    before = set(os.listdir(folder))
    packed = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    (left,) = set(os.listdir(folder)) - before
    assert left.startswith("best_fit_packing") and packed.count() > 100


def test_pipeline_of_odd_and_empty_tables(spark):
    text = "the cat of the house and a dog was on it for this with from that are in to be by as is " * 2
    rows = [(1, text, "en", None, 5), (1, text, "en", None, 5), (None, text.upper(), None, "a", None), (2, None, "x", "a", 1), (3, "", None, None, 0)]
    rows += [(4, text + "and the end of the road is near to it", "en", "b", 9), (5, "a " * 40000, "en", "b", 1)]
    types = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    df = spark.createDataFrame(rows, types).withColumn("row", F.lit("x")).withColumn("number", F.lit("y"))
    for docs in (df, df.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF).cache()
            docs.count()
