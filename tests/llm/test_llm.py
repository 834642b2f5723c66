"""Operators on texts against brute force, exact round trips and held-out accuracy."""

import bisect
import collections
import hashlib
import re
import sys
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent.parent.parent))

import corpus_pipeline  # noqa: E402
from sluicegate.llm import decontaminate, language_id, packing, sharding, simhash, suffix_dedup, wavelet  # noqa: E402
from sluicegate.llm import fingerprints as fp  # noqa: E402
from sluicegate.llm.common import numbered, whole_groups  # noqa: E402
from sluicegate.llm.html_extract import main_text  # noqa: E402
from sluicegate.llm.language_id import identify_documents  # noqa: E402
from sluicegate.llm.oracle import ORACLE  # noqa: E402
from sluicegate.llm.queries import QUERIES, RULES, tokenizer_path  # noqa: E402
from sluicegate.llm.suffix_sort import Hashed, merge_sorted  # noqa: E402
from sluicegate.llm.tokens import WordIds  # noqa: E402
from sluicegate.llm.url_filter import filter_urls  # noqa: E402

SF = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, _row string, shard int"
LONG = " ".join(f"w{i * 7919 % 10007}" for i in range(60_000))
PASSAGE = " ".join(f"common{i}" for i in range(60))
EDGES = [
    (1, "one two three four five six seven eight nine", "en"),
    (1, "one two three four five six seven eight nine", "en"),  # a repeated row
    (2, "one two three four five six seven eight nine", "en"),  # a copy
    (2, "another text of the same id", "en"),
    (3, None, None),
    (None, "no id here", "fr"),
    (4, "", "en"),
    (5, " \n\t", "de"),
    (6, "12 34 ... !!", "de"),
    (7, LONG, "en"),
    (8, "é" * 700 + "x", "fr"),
    (9, "y" + "é" * 700, "fr"),
    (10, "ab" * 900, "en"),
    (11, "start " + PASSAGE + " end of eleven", "en"),
    (12, "begin with " + PASSAGE + " and stop", "en"),
]


@pytest.fixture(scope="module")
def edges(spark):
    rows = [(*r, "s", len(r[1] or ""), "clash", 5) for r in EDGES]
    return spark.createDataFrame(rows, COLUMNS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], COLUMNS)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def rows(frame):
    return [tuple(r) for r in frame.collect()]


def both(spark, edges, documents):
    same = ["doc_id", "text"]
    return documents.select(*same).unionByName(edges.select((F.col("doc_id") + 10**6).alias("doc_id"), "text"))


# 1 ---------------------------------------------------------------------------------------------


def test_urls_against_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{SF}/pages.parquet'")
    frame = QUERIES["op1_url_filter"](spark, SF)
    found = con.execute(f"select {', '.join(frame.columns)} from ({ORACLE['op1_url_filter']})").fetchall()
    assert sorted(map(str, rows(frame))) == sorted(map(str, found))


@pytest.mark.parametrize(
    "url, host, path, rule, verdict",
    [
        (None, "", "", None, "allow"),
        ("", "", "", None, "allow"),
        ("no scheme", "", "", None, "allow"),
        ("http://A.Example.ORG/en/12?x#y", "a.example.org", "/en/12", "example.org/en/1", "block"),
        ("http://example.org", "example.org", "", None, "allow"),
        ("http://badexample.org/es/", "badexample.org", "/es/", "org/", "allow"),
        ("x://b.com/de/?q=://c", "b.com", "/de/", "com/de/", "block"),
        ("http://casino.example.net/", "casino.example.net", "/", None, "block"),
        ("http://casinos.example.net/", "casinos.example.net", "/", None, "allow"),
        ("http://free.example.net/free", "free.example.net", "/free", None, "allow"),
        ("http://free.example.net/Bets", "free.example.net", "/Bets", None, "block"),
    ],
)
def test_one_url(spark, url, host, path, rule, verdict):
    frame = spark.createDataFrame([(1, url, "old")], "page_id long, url string, host string")
    (row,) = filter_urls(frame, rules=RULES).collect()
    assert (row.host, row.path, row.rule, row.verdict) == (host, path, rule, verdict)


# 2 ---------------------------------------------------------------------------------------------


def brute_removed(texts, length):
    data = [(t or "").encode() for t in texts]
    count = collections.Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        mark = np.zeros(len(d) + 1, int)
        for i in range(len(d) - length + 1):
            if count[d[i : i + length]] > 1:
                mark[i : i + length] = 1
        kept = bytes(b for b, m in zip(d, mark) if not m)
        spans = int((np.diff(np.concatenate([[0], mark])) == 1).sum())
        out.append((len(d), int(mark.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("length, most", [(400, 4096), (90, 4096), (90, 1)])
def test_repeats_against_brute_force(spark, edges, documents, length, most, monkeypatch):
    docs = both(spark, edges, documents.where("doc_id < 60"))
    monkeypatch.setitem(suffix_dedup.repeated_spans.__globals__, "MOST", most)
    monkeypatch.setattr(suffix_dedup.repeated_spans, "__defaults__", (400, "doc_id", "text", most))
    texts = rows(docs)
    wanted = [(i, *x) for (i, _), x in zip(texts, brute_removed([t for _, t in texts], length))]
    assert sorted(map(str, rows(suffix_dedup.removed_repeats(docs, length)))) == sorted(map(str, wanted))


def test_repeats_of_an_empty_table(none):
    assert rows(suffix_dedup.removed_repeats(none)) == []


def test_blocks_do_not_change_repeats(monkeypatch):
    rng = np.random.default_rng(1)
    text = rng.integers(0, 4, 5000).astype(np.uint8).tobytes()
    whole = {(a, b) for a, b in found_windows([text], 10**6)}
    assert whole == {(a, b) for a, b in found_windows([text], 700)}


def found_windows(texts, block):
    table = suffix_dedup.powers(4 * 10**6)
    for data, where in suffix_dedup.pieces(texts, 64, block):
        first, last, at, key = suffix_dedup.segments(np.frombuffer(data, np.uint8), 64, table)
        origin = where[0][1]
        for a, b, k in zip(first, last, at):
            for w in range(a, b + 1):
                yield origin + w, origin + k


@pytest.mark.parametrize("weak", [False, True])
@pytest.mark.parametrize("seed", range(4))
def test_suffix_sort(seed, weak, monkeypatch):
    rng = np.random.default_rng(seed)
    bodies = [bytes(rng.integers(97, 99, rng.integers(60, 140)).astype(np.uint8)) for _ in range(60)]
    core = b"z" * 40
    bodies = [b[: len(b) // 2] + core + b[len(b) // 2 :] for b in bodies]
    bodies += [bodies[3][5:-5] for _ in range(3)]
    if weak:  # nearly all spans of a length collide: only the checks on bytes are right
        monkeypatch.setattr(
            Hashed, "span", lambda self, start, n: (self.prefix[start + n] - self.prefix[start]) & np.uint64(1)
        )
    keys = np.sort(rng.integers(0, 6, len(bodies)))
    places = np.array([b.index(core) for b in bodies])
    found = suffix_dedup.repeats(keys, places, bodies, 64)
    got, wanted = collections.defaultdict(set), collections.defaultdict(set)
    for m, a, b in found.tolist():
        got[m] |= set(range(a, b))
    for i, x in enumerate(bodies):
        for j, y in enumerate(bodies):
            if i != j and keys[i] == keys[j]:
                p, q, left, right = places[i], places[j], 0, 0
                while left < min(p, q) and x[p - left - 1] == y[q - left - 1]:
                    left += 1
                while right < min(len(x) - p, len(y) - q) and x[p + right] == y[q + right]:
                    right += 1
                if left + right >= 64:
                    wanted[i] |= set(range(p - left, p + right))
    if weak:
        assert all(got[m] <= wanted[m] for m in got)
    else:
        assert got == wanted


def test_order_of_suffixes():
    rng = np.random.default_rng(0)
    raw = rng.integers(0, 2, 300).astype(np.uint8)
    place = np.arange(300)
    order = merge_sorted(Hashed(raw), place, 300 - place, np.array([0]), np.array([300]))
    data = raw.tobytes()
    assert order.tolist() == sorted(range(300), key=lambda i: data[i:])


# 3 ---------------------------------------------------------------------------------------------

WORDS = [f"t{i}" for i in range(60)]


@pytest.mark.parametrize("limit", [2_000_000, 0])
def test_leaks(spark, limit, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", limit)
    monkeypatch.setattr(decontaminate, "BROADCAST_HITS", limit)
    changed = [w if i % 6 else "other" for i, w in enumerate(WORDS[:30])]
    far = [w if i % 3 else "other" for i, w in enumerate(WORDS[:30])]
    docs = [
        (1, "before " + " ".join(WORDS[:30]) + " after"), (2, "x, " + "; ".join(changed).upper()),
        (3, " ".join(far)), (4, " ".join(reversed(WORDS[:30]))), (5, None), (6, ""), (7, "t1 t2 t3"),
        (1, "before " + " ".join(WORDS[:30]) + " after"), (None, " ".join(WORDS[30:45])),
        (8, LONG + " " + " ".join(WORDS[30:45])),
    ]
    items = [(1, " ".join(WORDS[:30])), (2, " ".join(WORDS[30:45])), (3, "t1 t2 t3"), (4, None), (5, "")]
    docs = spark.createDataFrame([(*d, "clash") for d in docs], "doc_id long, text string, _row string")
    items = spark.createDataFrame(items, "item_id long, text string")
    found = rows(decontaminate.contaminated(docs, items))
    assert sorted(map(str, found)) == sorted(
        map(str, [(1, 1, 20, 20), (2, 1, found[[f[0] for f in found].index(2)][2], 20), (None, 2, 15, 15), (8, 2, 15, 15)])
    )
    assert rows(decontaminate.contaminated(docs, items.limit(0))) == []
    assert rows(decontaminate.contaminated(docs.limit(0), items)) == []


@pytest.mark.parametrize("n", range(1, 21))
def test_masks_meet_every_placement(n):
    import itertools

    marks = [[i for i, c in enumerate(m) if c == "1"] for m in decontaminate.masks_of(n)]
    for away in itertools.combinations(range(n), n - int(np.ceil(n * decontaminate.SHARE))):
        runs = ({s + i for i in m} for m in marks for s in range(n - m[-1]))
        assert any(run.isdisjoint(away) for run in runs), away


def test_leaks_with_any_places_replaced_and_short_items(spark):
    def without(n, *places):
        return " ".join("other" if i in places else f"t{i}" for i in range(n))

    docs = [
        (1, without(20, 3, 7, 11, 15)), (2, "a " + without(15, 2, 6, 10) + " b"), (3, without(10, 3, 6)),
        (4, "x u0 u1 u2 y"), (5, "u0 u1"), (6, "before v0 v1 other v3 v4 after"), (7, "solo w"), (8, None),
    ]
    items = [
        (20, without(20)), (15, without(15)), (10, without(10)), (3, "u0 u1 u2"), (5, "v0 v1 v2 v3 v4"),
        (1, "Solo!"), (0, ""), (4, "z0 z1 z2 z3"),
    ]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, items, shortest=1).collect()}
    assert {(1, 20), (2, 15), (3, 10), (4, 3), (6, 5), (7, 1)} <= found
    assert {d for d, _ in found} == {1, 2, 3, 4, 6, 7}
    found = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, items).collect()}
    assert {(1, 20), (2, 15), (3, 10)} <= found and not {i for _, i in found} & {1, 3, 5}


def test_leaks_against_exact_search(spark, documents):
    tokens = lambda t: " " + " ".join(re.findall(r"[^\W_]+", t.lower())) + " "
    items = rows(spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text"))
    texts = [(i, tokens(t)) for i, t in rows(documents.select("doc_id", "text"))]
    wanted = {(d, i) for i, item in items for d, t in texts if tokens(item) in t}
    found = {r[:2] for r in rows(QUERIES["op3_decontaminate"](spark, SF))}
    assert wanted and found == wanted


# 4 ---------------------------------------------------------------------------------------------


def test_languages(spark, edges, none):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    judged = identify_documents(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(judged) == docs.count()
    held = [r for r in judged if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in judged)
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in judged)
    few = {r.doc_id: r for r in identify_documents(edges).collect()}
    assert [few[i].lang_pred for i in (3, 4, 5, 6)] == ["und"] * 4
    assert few[7].lang_pred != "und" and few[3].score == 0
    assert rows(identify_documents(none)) == []


# 5 ---------------------------------------------------------------------------------------------


def expected_pieces(texts, tokenizer):
    for i, t in texts:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        for k, start in enumerate(range(0, len(ids), 2048)):
            part = np.array(ids[start : start + 2048], "<u4")
            yield i, k, start, len(part), zlib.crc32(part.tobytes())


def test_packing(spark, edges, documents, none, tokenizer):
    docs = both(spark, edges, documents)
    packed = packing.pack_documents(docs, tokenizer_path()).collect()
    wanted = list(expected_pieces(rows(docs), tokenizer))
    assert sorted(str(tuple(r)[:5]) for r in packed) == sorted(map(str, wanted))
    sequences = collections.defaultdict(list)
    for r in packed:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(r.length for r in packed)
    assert len(sequences) <= -(-total // 2048) + 1
    assert rows(packing.pack_documents(none, tokenizer_path())) == []


def test_knapsack():
    items, value = packing.best_configuration([0, 0, 3, 4.6, 0, 8.1], 7)
    assert sum(items) <= 7 and value == pytest.approx(8.1 + 3)


def test_word_ids(tokenizer):
    texts = [
        "Don't STOP, it's 12³ ½ ª_b -- \"x\"'s", "", "  a\tb\r\n", "naïve Ångström", "Σας ΟΔΟΣ", "e\u0301",
        "a\u00a0b", "日本語 text", "x\x1fy", "<|endoftext|> z", "İstanbul ﬁ", "''s 'll're",
    ]
    encoder = WordIds(tokenizer_path())
    for _ in range(2):
        found = [np.frombuffer(b, "<u2").tolist() for b in encoder.encode(texts)]
        assert found == [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


# 6 ---------------------------------------------------------------------------------------------


def test_tree_against_sorted_list():
    rng, tree, held = np.random.default_rng(3), sharding.Tree(), []
    for step in range(3000):
        if held and rng.random() < 0.45:
            key = held.pop(int(rng.integers(len(held))))
            tree.remove(key)
        else:
            key = (int(rng.integers(50)), step)
            bisect.insort(held, key)
            tree.add(key)
        room = int(rng.integers(55))
        at = bisect.bisect_left(held, (room, -1))
        assert tree.tightest(room) == (held[at] if at < len(held) else None)
    assert not held or tree.root[3] <= 1.45 * np.log2(len(held) + 2)


def test_best_fit_decreasing():
    assert sharding.best_fit_decreasing([4, 8, 1, 4, 2, 1], 10)[1] == 2
    assert sharding.best_fit_decreasing([], 10) == ([], 0)
    assert sharding.best_fit_decreasing([30, 1], 10)[1] == 2


@pytest.mark.parametrize("grains", [16, 8192])
def test_shards(spark, edges, documents, none, grains):
    docs = both(spark, edges, documents).where("doc_id is null or doc_id < 1000000 or doc_id <> 1000007")
    placed = sharding.shard_documents(docs, 24, grains=grains).collect()
    texts = rows(docs)
    known = sorted((str(i), len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in texts)
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in placed) == known
    by_text, sizes, slots = collections.defaultdict(set), collections.Counter(), collections.defaultdict(list)
    for r in placed:
        by_text[r.size, r.text_crc32].add(r.shard)
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert all(len(s) == 1 for s in by_text.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    if grains > 1000:
        groups = max(sum(r.size for r in placed) / 24, max(r.size for r in placed))
        assert len(sizes) == 24 and max(sizes.values()) <= 1.1 * groups
    assert rows(sharding.shard_documents(none)) == []


@pytest.mark.parametrize("share", [0.06, 0.1, 1 / 3, 0.9])
def test_large_groups_leave_the_rest_level(share):
    rng = np.random.default_rng(6)
    small = rng.integers(500, 1500, 8192).tolist()
    hot = int(sum(small) * share / (1 - share))
    for large in ([hot], [hot // 2, hot], [hot] * 23):
        places = sharding.near_equal([*small, *large], 24)
        loads = np.bincount(places, [*small, *large], 24)
        alone = [s for s in large if s * (24 - len(large)) > sum(small)]
        level = sorted(loads)[: 24 - len(alone)]
        assert sorted(loads)[24 - len(alone) :] == sorted(alone)
        even = sum(level) / len(level)
        assert 0.9 * even <= min(level) and max(level) <= 1.1 * even
    assert sorted(sharding.near_equal([5, 9], 3)) in ([0, 1], [0, 2], [1, 2])
    assert sharding.near_equal([], 3) == [] and sharding.near_equal([0, 0, 4], 1) == [0, 0, 0]


def test_shards_with_a_third_of_copies(spark):
    other = [(i, f"text {i} " + "x" * (i % 50)) for i in range(2000)]
    docs = spark.createDataFrame(other + [(9000 + i, "y" * 40) for i in range(1000)], "doc_id long, text string")
    sizes, hot = collections.Counter(), set()
    for r in sharding.shard_documents(docs, 24).collect():
        sizes[r.shard] += r.size
        hot |= {r.shard} if r.doc_id >= 9000 else set()
    assert len(hot) == 1 and sizes.pop(*hot) == 48_000
    assert len(sizes) == 23 and max(sizes.values()) <= 1.1 * sum(sizes.values()) / 23


def test_numbers_without_gaps(spark):
    frame = spark.range(1000).select("id", F.when(F.col("id") < 900, "hot").otherwise("cold").alias("k"))
    found = numbered(frame, ["k"], ["id"], "n", 7).groupBy("k").agg(F.sort_array(F.collect_list("n"))).collect()
    assert {r[0]: r[1] == list(range(len(r[1]))) for r in found} == {"hot": True, "cold": True}


def test_groups_stay_whole():
    import pyarrow as pa

    keys = sorted(np.random.default_rng(0).integers(0, 40, 1000).tolist())
    batches = pa.table({"k": keys}).to_batches(max_chunksize=37)
    found = [t.column("k").to_pylist() for t in whole_groups(iter(batches), ["k"], 50)]
    assert sum(found, []) == keys
    assert all(a[-1] != b[0] for a, b in zip(found, found[1:]))


# 7 ---------------------------------------------------------------------------------------------


def shingles(text, width=5):
    words = (text or "").lower().split()
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def test_fingerprints(spark, edges, documents, none):
    docs = both(spark, edges, documents).where("doc_id is not null").dropDuplicates(["doc_id"])
    texts = sorted(((i, t or "") for i, t in rows(docs)), reverse=True)
    found = {r.doc_id: r for r in fp.fingerprint_documents(docs).collect()}
    assert len(found) == len(texts)
    for at, (i, text) in enumerate(texts):
        after = texts[(at + 1) % len(texts)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        r = found[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        for near, other in ((r.near_edited, edited), (r.near_next, after)):
            a, b = shingles(text), shingles(other)
            true = len(a & b) / len(a | b) if a | b else 1.0
            small = len(a | b) <= fp.K
            assert near == pytest.approx(true, abs=1e-9 if small else 0.2)
    assert rows(fp.fingerprint_documents(none)) == []


def test_repeated_ids_follow_each_other(edges):
    assert fp.fingerprint_documents(edges).count() == len(EDGES)


def test_sketches_merge_and_estimate(spark):
    a = " ".join(f"a{i}" for i in range(3000))
    frame = spark.createDataFrame([(1, a), (1, "b " + a[:9000]), (2, None)], "g int, t string")
    sketched = frame.select("g", fp.sketch(F.col("t")).alias("s"))
    merged = {r.g: r.s for r in fp.merge_groups(sketched, "g", "s").collect()}
    parts = [r.s for r in sketched.where("g = 1").collect()]
    assert merged[1] == sorted(set(parts[0]) | set(parts[1]))[: fp.K]
    pair = spark.createDataFrame([(parts[0], parts[1])], "a array<bigint>, b array<bigint>")
    count, inside, none = pair.select(
        fp.distinct_shingles(F.col("a")), fp.containment(F.col("b"), F.col("a")),
        fp.resemblance(F.array().cast("array<bigint>"), F.array().cast("array<bigint>")),
    ).first()
    assert count == pytest.approx(2996, rel=0.35) and inside > 0.8 and none == 1


# 8 ---------------------------------------------------------------------------------------------


@pytest.mark.parametrize("n, block", [(0, 64), (1, 64), (1000, 64), (5000, 1 << 19)])
def test_wavelet_matrix(n, block):
    ids = np.random.default_rng(n).zipf(1.4, n).clip(0, 60_000).astype(np.uint16)
    reader = wavelet.Reader(wavelet.build(ids, [5], [n], block_bits=block))
    assert reader.all().tolist() == ids.tolist() and reader.documents.tolist() == [5]
    for place in range(0, n, 97):
        assert reader.access(place) == ids[place]
    for token in [0, 1, 2, 7, 60_000, 70_000]:
        at = np.flatnonzero(ids == token)
        assert reader.count(token) == len(at)
        assert reader.count(token, n // 2) == (at < n // 2).sum()
        for k in [*range(0, len(at), 37), len(at)]:
            assert reader.find(token, k) == (at[k] if k < len(at) else None)
    with pytest.raises(IndexError):
        reader.access(n)


def test_wavelet_files(spark, edges, documents, none, tokenizer):
    docs = both(spark, edges, documents).where("doc_id is not null").dropDuplicates(["doc_id"])
    found, start = wavelet.store_documents(docs, tokenizer_path()).orderBy("doc_id").collect(), 0
    texts = sorted((i, t or "") for i, t in rows(docs))
    for r, (i, t) in zip(found, texts, strict=True):
        ids = [*tokenizer.encode(t, add_special_tokens=False).ids, 1]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert tuple(r) == (i, start, len(ids), crc)
        start += len(ids)
    assert wavelet.store_documents(edges, tokenizer_path()).count() == len(EDGES)
    assert rows(wavelet.store_documents(none, tokenizer_path())) == []


# 9 ---------------------------------------------------------------------------------------------

PAGE = """<html><head><title>T</title><script>var a="</p>"</script></head><body><header>Head</header>
<nav><a href=/a>A</a></nav><div class="cookie-notice">Accept cookies now please, all of them</div>
{0}<div class="ad big">Buy this</div><section id="comments"><p>A long reader comment, which says much and more.</p>
</section><aside>Side</aside><form>Mail <input></form><footer>Foot</footer></body></html>"""


@pytest.mark.parametrize(
    "body, text",
    [
        ("<article><h1>Hi &amp; bye</h1><p>A  long\n paragraph of <b>text</b>s.<br>Next<p>No.</article>",
         "Hi & bye A long paragraph of texts. Next No."),
        ("<main><p>Only short.</p><div class=ad>Buy!</div><p>End</p></main>", "Only short. End"),
        ("<div><p>Some text without an article, long enough to be the main part.</p><p>Ok.</p></div>",
         "Some text without an article, long enough to be the main part. Ok."),
        ("", ""),
    ],
)
def test_main_text(body, text):
    assert main_text(PAGE.format(body)) == text


def test_pages_against_their_template(spark):
    import html

    pages = dict(rows(spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "html")))
    found = QUERIES["op9_html_extraction"](spark, SF).collect()
    assert len(found) == len(pages)
    for r in found:
        article = re.search(r"<article>(.*)</article>", pages[r.page_id], re.S)[1]
        article = re.sub(r"</?b>", "", re.sub(r"<(?:/?(?:p|h1)|br)>", " ", article))
        assert r.text == " ".join(html.unescape(article).split()) and r.n_chars == len(r.text)


@pytest.mark.parametrize("html", [None, "", "<", "<p", "no tags", "<div" * 2000, "</p>" * 2000])
def test_odd_pages(html):
    assert isinstance(main_text(html), str)


# 10 --------------------------------------------------------------------------------------------


def brute_fingerprint(text, width=3):
    import xxhash

    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]+", lambda m: m[0].lower(), (text or "").encode()))
    parts = [b" ".join(words[i : i + width]) for i in range(len(words) - width + 1)] or [b" ".join(words)]
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_near_duplicates(spark, edges, documents, none):
    docs = both(spark, edges, documents)
    texts = rows(docs)
    prints = {(i, t): brute_fingerprint(t) for i, t in texts}
    distinct = sorted(set(prints.values()))
    up = {p: p for p in distinct}

    def top(p):
        while up[p] != p:
            p = up[p]
        return p

    for k, a in enumerate(distinct):
        for b in distinct[k + 1 :]:
            if (a ^ b).bit_count() <= 3:
                up[top(b)] = top(a)
    least = {}
    for (i, _), p in prints.items():
        if i is not None:
            least[top(p)] = min(least.get(top(p), i), i)
    wanted = [(i, f"{prints[i, t]:016x}", least.get(top(prints[i, t]))) for i, t in texts]
    assert sorted(map(str, rows(simhash.near_duplicates(docs)))) == sorted(map(str, wanted))
    assert rows(simhash.near_duplicates(none)) == []


@pytest.mark.parametrize("spread", [3, 10, 64])
def test_trees_against_all_pairs(spread):
    rng = np.random.default_rng(spread)
    prints = np.unique(np.array([sum(1 << int(b) for b in rng.choice(spread, 3)) for _ in range(300)], np.uint64))
    shards = np.sort(rng.integers(0, 3, len(prints)))
    for radius in (0, 1, 3):
        found = {
            (int(a), int(b))
            for q, n in simhash.Trees(prints, shards).near(np.arange(len(prints)), radius, step=64)
            for a, b in zip(q, n)
        }
        wanted = {
            (a, b)
            for a in range(len(prints))
            for b in range(len(prints))
            if a != b and shards[a] == shards[b] and int(prints[a] ^ prints[b]).bit_count() <= radius
        }
        assert found == wanted


def test_every_link_within_the_radius_is_found(spark):
    rng = np.random.default_rng(8)
    pairs = []
    for _ in range(200):
        a = int(rng.integers(0, 2**63))
        pairs.append((a, a ^ sum(1 << int(b) for b in rng.choice(63, 3, replace=False))))
    frame = spark.createDataFrame([(p,) for pair in pairs for p in pair], "fingerprint long")
    found = {frozenset(r) for r in rows(simhash.links(frame))}
    assert {frozenset(p) for p in pairs} <= found


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 50), (101, 50), (7, 7)]
    found = dict(rows(simhash.components(spark.createDataFrame(edges, "a long, b long"))))
    assert found == {**{i: 0 for i in range(41)}, 50: 50, 100: 50, 101: 50}
    assert rows(simhash.components(spark.createDataFrame([], "a long, b long"))) == []


# Pipeline --------------------------------------------------------------------------------------


def test_pipeline_stage_by_stage(spark, tokenizer):
    docs, tables = spark.read.parquet(f"{SF}/documents.parquet"), []
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        tables.append(docs)
        docs = stage(spark, docs, SF).cache()
        if number < 4:
            assert docs.columns == tables[0].columns
    read = [{r.doc_id: r for r in t.collect()} for t in tables]
    lettered = {i for i, r in read[0].items() if r.text and re.search(r"[^\W\d_]", r.text)}
    network = language_id.fit(tables[0].where(~language_id.held_out()), reject=tables[0].where(language_id.held_out()))
    judged = {r.doc_id: r.lang_pred for r in language_id.identify(tables[0], network).collect()}
    assert set(read[1]) == {i for i in lettered if judged[i] != "und"} and len(read[1]) >= 0.99 * len(lettered)
    component = {r.doc_id: r.component_id for r in simhash.near_duplicates(tables[1]).collect()}
    assert set(read[2]) == {i for i, c in component.items() if i == c}
    removed = dict(zip(read[2], brute_removed([r.text for r in read[2].values()], corpus_pipeline.PASSAGE_BYTES)))
    assert set(read[3]) == set(read[2])
    for i, r in read[3].items():
        n, cut, _, _ = removed[i]
        assert n - cut <= len(r.text.encode()) <= n - cut + 6 * removed[i][2] and r.n_chars == len(r.text)
    leaks = {r[0] for r in rows(decontaminate.contaminated(tables[3], spark.read.parquet(f"{SF}/benchmark.parquet")))}
    assert set(read[4]) == set(read[3]) - leaks
    wanted = list(expected_pieces([(i, r.text) for i, r in read[4].items()], tokenizer))
    assert sorted(tuple(r)[:5] for r in docs.collect()) == sorted(wanted)


def test_stages_on_edges_and_nothing(spark, edges, none):
    for frame in (edges, none):
        docs = frame
        for _, stage in corpus_pipeline.STAGES[:4]:
            docs = stage(spark, docs, SF)
            assert docs.columns == frame.columns
        kept = [r.doc_id for r in docs.collect()]
        assert len(kept) == len(set(kept))
        assert corpus_pipeline.STAGES[4][1](spark, docs, SF).count() >= len(kept)


def test_passages_of_over_fifty_words_go(spark):
    rng = np.random.default_rng(4)
    word = lambda low, high: bytes(rng.integers(97, 123, rng.integers(low, high)).astype(np.uint8)).decode()
    text = lambda n, low=3, high=9: " ".join(word(low, high) for _ in range(n))
    passages = [text(51, 1, 2), text(53, 3, 8), text(98, 2, 4)]  # 101 bytes; others under 400
    assert [len(p) >= 101 and len(p) < 400 for p in passages] == [True] * 3 and len(passages[0]) == 101
    docs = [(2 * k + n, f"{text(40)} {p} {text(40)}") for k, p in enumerate(passages) for n in range(2)]
    short = text(12, 3, 8)  # under 101 bytes: stays
    docs += [(10, f"{text(40)} {short} {text(40)}"), (11, f"{text(40)} {short} {text(40)}")]
    frame = spark.createDataFrame([(*d, "en", "s", len(d[1]), "clash", 5) for d in docs], COLUMNS)
    found = {r.doc_id: r for r in corpus_pipeline.repeated_passages(spark, frame, SF).collect()}
    for i, t in docs[:6]:
        left = t.replace(passages[i // 2], "").replace("  ", "")
        assert found[i].text.replace(" ", "") == left.replace(" ", "") and found[i].n_chars == len(found[i].text)
    assert [found[i].text for i in (10, 11)] == [t for _, t in docs[6:]]


def test_language_stage_rejects_what_is_no_language(spark):
    rng = np.random.default_rng(9)
    draw = lambda signs, n: "".join(rng.choice(list(signs), n))
    lower, many = "abcdefghijklmnopqrstuvwxyz", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/"
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    clean = docs.where("lang is not null").orderBy("doc_id").limit(3).collect()
    planted = [draw(lower, 900), draw(many, 900), draw(lower + "    ", 900), draw("0123456789abcdef", 900)]
    planted += ["xq zj " * 150, "a" * 900, *["".join(rng.permutation(list(r.text[:1500]))) for r in clean]]
    bad = spark.createDataFrame([(10**9 + k, t) for k, t in enumerate(planted)], "doc_id long, text string")
    kept = corpus_pipeline.language(spark, docs.unionByName(bad, allowMissingColumns=True), None)
    kept = {r.doc_id for r in kept.select("doc_id").collect()}
    assert kept == {r.doc_id for r in docs.select("doc_id").collect()}
