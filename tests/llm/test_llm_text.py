"""Quality rules, token counts, packing, mixing and sharding against SQL, brute force and round trips."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from conftest import SF
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.compare import compare
from millrace.llm import ORACLES, QUERIES, mixing, packing, quality, sharding, token_counts
from millrace.llm.queries import QUALITY_COLUMNS, QUALITY_SQL, shard_sql

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PROSE = "the cat of the house and a dog was on it for this with from that are in to be by as is"


def odd_rows():
    """Nulls in any column, empty, blank and long texts, repeated rows, ties."""
    rng = random.Random(3)
    words = PROSE.split() + ["naïve", "x#y", "Straße.", "日本語", "<|endoftext|>", "don't", "ﬁ", "1234"]
    rows = [
        (0, None, "a", 0), (1, "", "a", None), (2, " \t\n ", None, 1), (None, "the house of the cat", "b", 2),
        (4, " ".join(rng.choices(words, k=5000)), "hot", 3), (5, PROSE, "hot", 4), (5, PROSE, "hot", 4),
        (6, "  two  spaces\n\n and\x0blines \r\n", "b", 5), (7, "word " * 300, None, 6), (8, "A\x1cb c d e", "", 7),
        (9, "line one of it\nline one of it\n" * 12, "c", 8),
    ]
    rows += [(10 + i, " ".join(rng.choices(words, k=rng.randint(1, 400))), rng.choice(["hot", "hot", "b", None]), i) for i in range(60)]
    return rows


@pytest.fixture
def odd(spark):
    """With extra columns that carry names the operators use inside."""
    df = spark.createDataFrame(odd_rows(), "doc_id bigint, text string, source string, n_chars bigint")
    extra = "size rank row id h block kept _id _t _w n_words number start cuts bytes hash shard bucket".split()
    return df.select("*", *[F.lit("x").alias(c) for c in extra])


@pytest.fixture
def none(odd):
    return odd.limit(0)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    problem, rows = compare(QUERIES[name](spark, SF), ORACLES[name], SF)
    assert problem is None
    assert rows > 0


def test_quality_of_odd_texts(spark, odd, none, tmp_path):
    # The SQL tells texts apart by their id, so here each row gets one of its own.
    path = str(tmp_path / "documents.parquet")
    odd.withColumn("doc_id", F.monotonically_increasing_id()).write.parquet(path)
    numbered = spark.read.parquet(path)
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/*.parquet'")
    expected = sorted(con.sql(QUALITY_SQL).fetchall(), key=repr)
    got = sorted([tuple(r) for r in quality.apply_rules(numbered).select(*QUALITY_COLUMNS).collect()], key=repr)
    assert got == expected
    assert quality.apply_rules(none).count() == 0
    kept = quality.kept_documents(odd)
    assert kept.columns == odd.columns
    ids = Counter(r.doc_id for r in quality.apply_rules(odd).collect() if r.kept)
    assert Counter(r.doc_id for r in kept.collect()) == ids and ids[5] == 2 and sum(ids.values()) == sum(r[-1] for r in got)


def test_quality_runs_no_python(odd):
    plan = quality.apply_rules(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_token_counts(odd, none):
    tokenizer = Tokenizer.from_file(WORD_BPE)
    got = [tuple(r) for r in token_counts.count_tokens(odd, WORD_BPE, 100).collect()]
    expected = []
    for doc_id, text, *_ in odd_rows():
        n = len(tokenizer.encode(text or "", add_special_tokens=False))
        expected.append((doc_id, len((text or "").encode()), n, n > 100))
    assert Counter(got) == Counter(expected)
    assert token_counts.count_tokens(none, WORD_BPE).count() == 0


def test_batches_of_texts_agree_with_the_tokenizer():
    """New words of a batch are merged together; memory that is too small, or full of long words, changes nothing."""
    rng = random.Random(5)
    letters = "abcdeghilnorstu" * 3 + "éèñüßÀÿ×÷ćжλ中🙂'’.,-0189\t\r\x1c\x85\xa0\u2003\u2028"
    words = ["".join(rng.choices(letters, k=rng.randint(1, 12))) for _ in range(400)] + ["a" * 63, "a" * 300, "x" * 64 + ".", "<|endoftext|>"]
    words += ["aaaa", "aaaaaaa", "ababab", "lalalala", "the", "The", "don't", "'s", "it's,"]
    texts = ["".join(rng.choice(words) + rng.choice(4 * [" "] + [*"\n\t", "  ", " \n", "\n\n"]) for _ in range(rng.randint(1, 60))) for _ in range(200)]
    texts += [" ".join(rng.choices(words, k=40)) for _ in range(50)] + ["", " ", "\n", "\n\n", " a", "a ", "\na", "a\n", "a\n b", "é\né", "\xa0a", "a\xa0 b"]
    tokenizer = Tokenizer.from_file(BYTE_BPE)
    expected = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    for memory in (20, 1_000_000):
        encoder = packing.UnitEncoder(BYTE_BPE, memory)
        assert encoder.merges.exact
        for size in (1, 7, len(texts)):
            found = [ids.tolist() for low in range(0, len(texts), size) for ids in encoder.encode_all(texts[low : low + size])]
            for text, got, ids in zip(texts, found, expected):
                assert got == ids, repr(text)


def test_new_words_are_not_merged_one_by_one(monkeypatch):
    """Words of letters take no call of the tokenizer each, whatever follows them."""
    rng = random.Random(6)
    texts = [" ".join("".join(rng.choices("abcdefghijé", k=9)) + rng.choice(["", ",", "."]) for _ in range(500)) for _ in range(4)]
    encoder, calls = packing.UnitEncoder(BYTE_BPE), []
    one = encoder.tokens
    monkeypatch.setattr(encoder, "tokens", lambda text: calls.append(text) or one(text))
    encoder.encode_all(texts)
    assert len(encoder.numbers) > 1900 and len(calls) <= 2


def test_encoders_agree_with_the_tokenizers():
    rng = random.Random(4)
    letters = ["a", "B", "é", " ", "  ", "\n", "'", "s", "t", "ll", ".", ",", "1", "ł", "́", "<|endoftext|>", "日", "\xa0", "_", "İ", "\x1c"]
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 14))) for _ in range(5000)]
    encoder = packing.UnitEncoder(BYTE_BPE)
    counter = token_counts.WholeTokenCounter(WORD_BPE, token_counts.prove_whole_tokens(WORD_BPE))
    assert counter.cuts
    for text in texts:
        assert encoder.encode(text) == encoder.ids(text), repr(text)
        assert counter.count(text) == len(counter.tokenizer.encode(text, add_special_tokens=False)), repr(text)


def test_every_proved_token_is_one_token():
    tokenizer = Tokenizer.from_file(WORD_BPE)
    for piece in list(token_counts.prove_whole_tokens(WORD_BPE))[:2000]:
        assert len(tokenizer.model.tokenize(piece)) == 1


def check_packing(rows, texts, length, slack):
    tokenizer = Tokenizer.from_file(BYTE_BPE)
    total, by_doc, by_sequence = 0, defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
        total += r.length
    for doc_id, text in texts:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        pieces = sorted(by_doc[doc_id], key=lambda r: r.piece)
        copies = sum(1 for d, _ in texts if d == doc_id)
        assert sum(p.length for p in pieces) == copies * len(ids)
        for p in pieces:
            part = np.array(ids[p.start : p.start + p.length], dtype="<u4")
            assert len(part) == p.length and zlib.crc32(part.tobytes()) == p.ids_crc32
            assert p.length == length or p.piece == 0
    for places in by_sequence.values():
        end = 0
        for offset, size in sorted(places):
            assert offset == end
            end += size
        assert end <= length
    assert len(by_sequence) <= -(-total // length) * slack + 1


def test_packing_round_trip(spark, odd, none):
    texts = [(r[0], r[1]) for r in odd_rows()]
    rows = packing.pack_documents(odd, BYTE_BPE, 2, 64, group_pieces=50).collect()
    check_packing(rows, texts, 64, 1.2)
    assert packing.pack_documents(none, BYTE_BPE, 2, 64).count() == 0
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = packing.pack_documents(docs, BYTE_BPE, 2, 1024).collect()
    check_packing(rows, [(r.doc_id, r.text) for r in docs.collect()], 1024, 1.01)


def test_sequences_hold_the_tokens(odd):
    pieces = packing.tokenize(odd, BYTE_BPE, 2, 64, with_ids=True).cache()
    placed = packing.pack(pieces.drop("ids"), 64).cache()
    whole = packing.sequences(placed, pieces).collect()
    assert sum(len(r.ids) for r in whole) == placed.agg(F.sum("length")).first()[0]
    assert max(len(r.ids) for r in whole) <= 64


@pytest.mark.parametrize("seed", range(6))
def test_sum_of_squares_places_by_its_rule(seed):
    """Every piece goes where the sum of the squared numbers of open sequences per gap becomes smallest, by trying them all."""
    rng, capacity = random.Random(seed), (10, 17, 40)[seed % 3]
    lengths = [6, 5, 5, 4, 3, 2, 1] if not seed else [rng.randint(1, capacity) for _ in range(120)]
    lengths = sorted(lengths, reverse=True) if seed % 2 else lengths
    sequence, offset = packing.place(np.array(lengths), capacity)
    used = {}

    def squares(filled):
        gaps = Counter(capacity - n for n in filled.values() if n < capacity)
        return sum(n * n for n in gaps.values())

    for s, o, n in zip(sequence.tolist(), offset.tolist(), lengths):
        rooms = [t for t, filled in used.items() if filled + n <= capacity]
        if not rooms:
            assert s not in used and o == 0
        else:
            assert s in rooms and o == used[s]
            assert squares({**used, s: o + n}) == min(squares({**used, t: used[t] + n}) for t in rooms)
        used[s] = o + n
    assert max(used.values()) <= capacity


def targets_by_hand(sizes, mix):
    """Share by weight, stop at the cap, share again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: mix.weights[i % len(mix.weights)] for i, s in enumerate(names)}
    target, left, free = {}, mix.total * sum(sizes.values()), set(names)
    while free:
        unit = left / sum(weight[s] for s in free)
        full = {s for s in free if unit * weight[s] >= mix.most * sizes[s]}
        if not full:
            target |= {s: unit * weight[s] for s in free}
            break
        target |= {s: mix.most * sizes[s] for s in full}
        left -= sum(mix.most * sizes[s] for s in full)
        free -= full
    return target


@pytest.mark.parametrize("block", [16, 128])
def test_mix(spark, odd, none, block):
    mix = mixing.Mix(block=block, shard_slots=50)
    rows = mixing.taken(odd, mix).collect()
    sizes = defaultdict(int)
    for _, text, source, _ in odd_rows():
        sizes[source] += len((text or "").replace("\x1c", "x").replace(" ", "x").replace(" ", "x").split())
    expected = targets_by_hand(sizes, mix)
    assert len(rows) == len(odd_rows())
    assert all(0 <= r.taken <= 2 * r.size for r in rows)
    by_target = defaultdict(int)
    for r in rows:
        by_target[round(r.target, 6)] += r.taken
    for source, target in expected.items():
        assert abs(by_target[round(target, 6)] - target) <= 2 * block
    assert Counter(map(tuple, rows)) == Counter(map(tuple, mixing.taken(odd.repartition(3), mix).collect()))
    assert mixing.taken(none, mix).count() == 0


def test_mixture_uses_each_block_at_most_twice_and_fills_all_slots(spark):
    mix = mixing.Mix(block=64, shard_slots=100)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    _, sources = mixing.layout(docs, mix, "doc_id", "text", "source")
    plan = mixing.mixture(sources, mix).cache()
    quota = {r["rank"]: r for r in mixing.quotas(sources, mix).collect()}
    assert plan.count() == sum(q["slots"] for q in quota.values()) == plan.select("shard", "slot").distinct().count()
    for r in plan.groupBy("rank", "block").count().collect():
        q = quota[r["rank"]]
        assert q["slots"] // q["blocks"] <= r["count"] <= -(-q["slots"] // q["blocks"]) and 0 <= r["block"] < q["blocks"]
    # The draw per shard varies, as multinomial counts do.
    per_shard = plan.where("rank = 0").groupBy("shard").count().collect()
    assert len({r["count"] for r in per_shard}) > 3


@pytest.mark.parametrize("size", [1, 2, 7, 64, 1000])
def test_permutation(spark, size):
    df = spark.range(size).select(mixing.permuted(F.col("id"), F.lit(size).cast("bigint"), 3, F.lit(5)).alias("p"))
    got = [r.p for r in df.collect()]
    assert sorted(got) == list(range(size))
    assert size < 64 or got != sorted(got)


def test_mixed_documents_hold_the_words_taken(odd, none):
    mix = mixing.Mix(block=16, shard_slots=50)
    out = mixing.mixed_documents(odd, mix)
    assert out.columns == odd.columns
    expected = defaultdict(int)
    for r in mixing.taken(odd, mix).collect():
        expected[r.doc_id] += r.taken
    got = defaultdict(int)
    texts = defaultdict(set)
    for doc_id, text, *_ in odd_rows():
        texts[doc_id].add(text)
    for r in out.select("doc_id", "text", "size").collect():
        got[r.doc_id] += len([w for w in _words(r.text)])
        assert r["size"] == "x"
    assert {k: v for k, v in expected.items() if v} == got
    assert mixing.mixed_documents(none, mix).count() == 0


def _words(text):
    import re

    return re.findall(r"[^\x20\x09-\x0D]+", text)


def test_shards(spark, odd, none, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    problem, rows = compare(sharding.shard(docs, 50_000), shard_sql(50_000), SF)
    assert problem is None and rows == 1000
    # A limit below the largest document, and equal rows that no hash can part.
    small = sharding.shard(odd.unionByName(odd.where("doc_id = 5")), 300).collect()
    sizes = defaultdict(int)
    for r in small:
        sizes[r.shard] += r.n_bytes
    assert len(small) == len(odd_rows()) + 2
    for r in small:
        assert sizes[r.shard] == r.shard_bytes and (r.shard_bytes <= 300) != r.oversized
    names = sorted(sizes)
    assert not any(b.startswith(a) for a, b in zip(names, names[1:]))
    assert sharding.shard(none, 100).count() == 0


def test_written_shards_hold_all_rows(spark, odd, folder):
    path = folder("shards")
    sharding.write_shards(odd.drop("bucket"), path, 5000)
    back = spark.read.parquet(path)
    assert back.count() == len(odd_rows()) and back.select("_shard").distinct().count() > 2
