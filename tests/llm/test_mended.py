"""What earlier rounds left open: packing, extraction, shards of near copies, letters, odd ids and short items."""

import collections
import itertools
import pickle
import sys
import tracemalloc
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent.parent))

from sluicegate.llm import decontaminate, html_extract, language_id, packing, queries, simhash, suffix_dedup, wavelet  # noqa: E402
from sluicegate.llm.html_extract import extract_text, main_text  # noqa: E402
from sluicegate.llm.url_filter import SOFT, STRICT, Vocabulary, filter_urls  # noqa: E402

SF = "/root/testdata/sf0.001"


def rows(frame):
    return [tuple(r) for r in frame.collect()]


# 1 ---------------------------------------------------------------------------------------------


def test_weights_of_urls_matter(spark):
    assert not set(STRICT) & set(SOFT) and len(set(SOFT.values())) > 3
    urls = ["http://a.org/free-download", "http://a.org/free/pills", "http://a.org/keygen.torrent", "http://a.org/hot/win/diet", "http://a.org/free/free/free"]
    frame = spark.createDataFrame([(i, u, 1, "x") for i, u in enumerate(urls)], "page_id int, url string, soft_terms int, _hits string")
    found = {r.page_id: r for r in filter_urls(frame).collect()}
    assert [found[i].verdict for i in range(5)] == ["allow", "block", "block", "allow", "allow"]
    assert [found[i].soft_terms for i in range(5)] == [2, 2, 2, 3, 1]
    assert found[0]._hits == "x"
    heavy = Vocabulary(strict=(), soft={"a": 0.5, "b": 1.5}, soft_limit=1.5)
    judged = {r.page_id: r.verdict for r in filter_urls(frame.selectExpr("page_id", "concat('http://x.org/', array('a', 'b', 'a-b', 'ab', 'c')[page_id]) as url"), vocabulary=heavy).collect()}
    assert judged == {0: "allow", 1: "block", 2: "block", 3: "allow", 4: "allow"}


def test_url_tables_that_are_empty_or_have_long_urls(spark):
    frame = spark.createDataFrame([(1, "http://a.org/" + "x/" * 500_000 + "viagra")], "page_id int, url string")
    assert [r.verdict for r in filter_urls(frame).collect()] == ["block"]
    assert rows(filter_urls(frame.where("false"))) == []


# 3 ---------------------------------------------------------------------------------------------


def near_copies_brute(docs, items):
    """Pairs whose item, laid over the document anywhere, agrees in four fifths of 20 tokens in a row."""
    found = set()
    for d, text in docs:
        have = (text or "").split()
        for i, item in items:
            want = item.split()
            width = min(len(want), decontaminate.SPAN)
            for shift in range(-len(want), len(have)):
                same = [0 <= shift + k < len(have) and have[shift + k] == w for k, w in enumerate(want)]
                if any(sum(same[s : s + width]) >= np.ceil(width * decontaminate.SHARE) for s in range(len(same) - width + 1)):
                    found.add((d, i))
                    break
    return found


def test_leaks_with_replaced_tokens_against_brute_force(spark):
    rng = np.random.default_rng(6)
    items = [(i, " ".join(f"w{rng.integers(0, 300)}" for _ in range(n))) for i, n in enumerate([5, 6, 8, 9, 10, 13, 15, 18, 20, 25, 40])]
    docs = []
    for d in range(150):
        words = items[rng.integers(len(items))][1].split()
        start = rng.integers(0, max(1, len(words) - 4))
        words = words[start:] if rng.random() < 0.3 else words
        for k in rng.choice(len(words), rng.integers(0, len(words) // 2 + 1), replace=False):
            words[k] = f"x{rng.integers(1000)}"
        around = [f"y{rng.integers(1000)}" for _ in range(20)]
        cut = rng.integers(0, 20)
        docs.append((d, " ".join([*around[:cut], *words, *around[cut:]])))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    table = spark.createDataFrame(items, "item_id long, text string")
    found = {r[:2] for r in rows(decontaminate.contaminated(frame, table, shortest=5))}
    assert found == near_copies_brute(docs, items) and 20 < len(found) < 150


def test_short_items_mark_only_documents_that_consist_of_them(spark):
    docs = spark.createDataFrame([(1, "the"), (2, "The!"), (3, "the end"), (4, "in the end of it"), (5, None), (6, "a b c d e f")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "the"), (2, "The END."), (3, "b c d e"), (4, "a b c d e")], "item_id long, text string")
    found = decontaminate.contaminated(docs, items, shortest=1, whole_below=5)
    assert {r[:2] for r in rows(found)} == {(1, 1), (2, 1), (3, 2), (6, 4)}


def test_a_large_benchmark_is_not_broadcast(spark, monkeypatch):
    docs = spark.createDataFrame([(1, " ".join(f"t{i}" for i in range(30)))], "doc_id long, text string")
    wanted = rows(decontaminate.contaminated(docs, docs.withColumnRenamed("doc_id", "item_id")))
    monkeypatch.setattr(decontaminate, "BROADCAST_TOKENS", 0)
    assert rows(decontaminate.contaminated(docs, docs.withColumnRenamed("doc_id", "item_id"))) == wanted != []


# 4 ---------------------------------------------------------------------------------------------


@pytest.mark.parametrize("text, letter", [("²", False), ("½ ① ⅷ", False), ("1_2", False), ("² x", True), ("日", True), ("ª", True), ("", False)])
def test_letters(text, letter):
    assert language_id.has_letter(text) == letter
    network = language_id.Network(["de", "en"])
    assert (network.predict([text])[0] == ("und", 0.0)) == (not letter)


def test_network_against_plain_loops():
    rng = np.random.default_rng(2)
    network = language_id.Network(["a", "b", "c"], embedding=3, widths=(2, 4), filters=5)
    for k in network.weights:
        network.weights[k] = rng.normal(0, 1, network.weights[k].shape).astype(np.float32)
    w, batch = network.weights, rng.integers(0, 256, (4, 12)).astype(np.uint8)
    wanted = []
    for row in batch:
        features = []
        for k in network.widths:
            for f in range(5):
                best = -np.inf
                for at in range(len(row) - k + 1):
                    total = sum(
                        float(w["embedding"][row[at + i], e]) * float(w[f"filter{k}"][i * 3 + e, f]) for i in range(k) for e in range(3)
                    )
                    best = max(best, total)
                features.append(max(best + float(w[f"bias{k}"][f]), 0.0))
        z = [sum(x * float(w["out"][j, c]) for j, x in enumerate(features)) + float(w["shift"][c]) for c in range(3)]
        e = np.exp(np.array(z) - max(z))
        wanted.append(e / e.sum())
    assert np.allclose(network.probabilities(batch), wanted, atol=1e-4)


def test_places_and_gradients_against_plain_loops():
    """Exact, as all numbers are small integers; of equal responses the first place counts, windows are of any length."""
    rng = np.random.default_rng(4)
    for length, count in [(12, 70), (13, 5), (4, 3), (31, 33)]:
        network = language_id.Network(["a", "b"], embedding=3, widths=(2, 4, 3), filters=5)
        for k in network.weights:
            network.weights[k] = rng.integers(-2, 3, network.weights[k].shape).astype(np.float32)
        w, batch = network.weights, rng.integers(0, 3, (count, length)).astype(np.uint8)
        best, at = network.pooled(batch, places=True)
        assert (network.pooled(batch)[0] == best).all()
        for i, k in enumerate(network.widths):
            spans = np.stack([w["embedding"][batch[:, p : p + k]].reshape(count, -1) for p in range(length - k + 1)], 1)
            responses = spans @ w[f"filter{k}"]
            own = slice(5 * i, 5 * i + 5)
            assert (best[:, own] == np.maximum(responses.max(axis=1) + w[f"bias{k}"], 0)).all()
            assert (at[:, own] == responses.argmax(axis=1)).all()
        wanted = rng.integers(0, 2, count)
        grads = network.gradients(batch, wanted)
        p = network._softmax(best)
        p[np.arange(count), wanted] -= 1
        back = (p / count @ w["out"].T) * (best > 0)
        embedding = np.zeros((256, 3))
        for i, k in enumerate(network.widths):
            filters = np.zeros((k * 3, 5))
            for r in range(count):
                for f in range(5):
                    g, seen = float(back[r, 5 * i + f]), batch[r, at[r, 5 * i + f] :][:k]
                    filters[:, f] += g * w["embedding"][seen].ravel()
                    for place, byte in enumerate(seen):
                        embedding[byte] += g * w[f"filter{k}"][3 * place : 3 * place + 3, f]
            assert np.allclose(grads[f"filter{k}"], filters, atol=1e-4)
        assert np.allclose(grads["embedding"], embedding, atol=1e-4)


def peak(work):
    tracemalloc.start()
    work()
    found = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return found


def test_bytes_are_not_copied_for_every_place():
    """The copies took much of the time; 16 MB of arrays before."""
    batch = np.random.default_rng(6).integers(1, 256, (256, language_id.WINDOW)).astype(np.uint8)
    network = language_id.Network(["a", "b"])
    assert peak(lambda: network.probabilities(batch)) < 3_000_000
    sent = pickle.dumps(network)  # to tasks: the weights only
    assert len(sent) < 40_000
    copied = pickle.loads(sent).copy()
    assert all(w.dtype is np.dtype(np.float32) for w in copied.weights.values())  # or np.add.at is slow
    assert all((w == network.weights[k]).all() for k, w in copied.weights.items())


def labelled(spark, texts):
    rows = [(k, t, lang) for k, (t, lang) in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(2, "doc_id")


def test_every_labelled_text_trains_the_network(spark):
    """Words that the windows of the start do not have, in all other texts, are learned."""
    old = [("der hund und die katze " * 4, "de"), ("the dog and the cat is " * 4, "en")]
    new = [("qx zw qx zw qx " * 16, "de"), ("vj kk vj kk vj " * 16, "en")]
    docs = labelled(spark, old * 3 + new * 6000)
    start = [(lang, text) for text, lang in old]
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(language_id, "starting_windows", lambda *_: start)
        network = language_id.fit(docs)
    found = network.predict([text for text, _ in old + new])
    assert [lang for lang, _ in found] == ["de", "en"] * 2
    assert min(score for _, score in found[2:]) > 0.9


def test_every_text_that_did_not_train_sets_the_limit(spark):
    network = language_id.Network(["de", "und"])
    texts = [f"{k} {'abc' * (k % 90)}" for k in range(3000)]
    rows = labelled(spark, [(t, "de") for t in texts] + [(None, "de"), ("12", "de"), ("abc", None)])
    blocks = language_id.window_blocks(
        [pa.record_batch([pa.array(texts), pa.array(["und"] * 3000)], ["text", "lang"])], {"und": 0}
    )
    network.weights["shift"][:] = (0, 3)  # so that no window is surely a language
    limit = language_id.rejection_limit(network, language_id.lettered(rows))
    found = np.concatenate([network.probabilities(b)[:, -1] for b, _, _ in blocks])
    assert abs(limit - np.quantile(found, 0.999)) < 0.01 and limit > 0.5
    assert language_id.rejection_limit(network, rows.where("false")) == 0.5


def test_blocks_lose_no_byte():
    texts = ["ab" * 5000, "", "x", "é" * 700, "y" * 256]
    batch = pa.record_batch([pa.array(texts), pa.array(["a", "b", "a", "b", "a"])], ["text", "lang"])
    blocks = list(language_id.window_blocks([batch], {"a": 0, "b": 1}))
    rows, own = (np.concatenate([b[k] for b in blocks]) for k in (0, 1))
    for number, wanted in enumerate([texts[0] + texts[2] + texts[4], texts[1] + texts[3]]):
        kept = rows[own == number]
        assert sorted(kept[kept > 0].tolist()) == sorted(wanted.encode())


# 5 ---------------------------------------------------------------------------------------------


def used(plan):
    return sum(times for _, times in plan)


@pytest.mark.parametrize(
    "lengths, best",
    [({1030: 600, 524: 600, 518: 600, 500: 1200}, 900), ({700: 3000, 1300: 2000, 650: 500}, 2625), ({2048: 5}, 5), ({1: 3}, 1)],
)
def test_packings_with_fewer_sequences_than_best_fit(lengths, best):
    plan, left = packing.solve(lengths, 2048)
    filled = packing.fill(left, 2048, plan)
    held = collections.Counter()
    for items, times in filled:
        assert sum(items) <= 2048
        for x in items:
            held[x] += times
    assert held == lengths and used(filled) == best <= used(packing.fill(dict(lengths), 2048, []))


def test_the_program_places_most_tokens():
    rng = np.random.default_rng(1)
    lengths = collections.Counter(np.minimum(2048, rng.gamma(2, 400, 12_000).astype(int) + 1).tolist())
    plan, left = packing.solve(lengths, 2048)
    total = sum(x * n for x, n in lengths.items())
    assert sum(x * n for x, n in left.items()) < (packing.SMALL + packing.REST) * total
    assert used(packing.fill(left, 2048, plan)) <= 1.001 * total / 2048 + 1


def test_configurations_against_all_multisets():
    rng = np.random.default_rng(5)
    for _ in range(40):
        values = np.where(rng.random(19) < 0.4, rng.random(19), 0)
        values[0] = 0
        kinds = np.flatnonzero(values)
        best = max(
            (sum(values[list(c)]) for n in range(19) for c in itertools.combinations_with_replacement(kinds, n) if sum(c) <= 18),
            default=0,
        ) if len(kinds) and kinds[0] > 3 else None
        items, value = packing.best_configuration(values, 18)
        assert sum(items) <= 18 and np.isclose(sum(values[items]) if items else 0, value)
        assert best is None or np.isclose(value, best)


# 8 ---------------------------------------------------------------------------------------------


def test_ids_of_all_sizes_and_none_come_back(spark):
    ids = [-(2**63), -1, 0, 2**63 - 1, None, None]
    docs = spark.createDataFrame([(i, "word") for i in ids], "doc_id long, text string").repartition(3)
    found = wavelet.store_documents(docs, queries.tokenizer_path()).orderBy("start").collect()
    assert [r.doc_id for r in found] == [None, None, *sorted(ids[:4])]
    assert [r.start for r in found] == list(range(0, 2 * len(ids), 2))


def test_files_end_after_the_document_that_fills_them(spark):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(queries.tokenizer_path())
    docs = [(i, "one two three " * (i % 7) + ("é x" if i % 5 else "日本")) for i in range(60)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    folder = wavelet.work_dir(spark, "few")
    manifest = wavelet.checkpointed(wavelet.write_shards(frame, folder, queries.tokenizer_path(), tokens=40))
    sizes = [r.n_ids for r in manifest.orderBy("part", "number").collect()]
    assert len(sizes) > 5 and sum(n >= 40 for n in sizes) >= len(sizes) - manifest.select("part").distinct().count()
    start = 0
    for r, (i, t) in zip(wavelet.read_shards(manifest, folder).orderBy("doc_id").collect(), docs, strict=True):
        ids = [*own.encode(t, add_special_tokens=False).ids, 1]
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


# 9 ---------------------------------------------------------------------------------------------

LONG = "This paragraph says a good deal about its subject, at some length, as the main text of a page does."


@pytest.mark.parametrize(
    "page, text",
    [
        ("<article><p class='byline'>By X<p>First one.<p>Second one.</article>", "By X First one. Second one."),
        (f"<article><p class='ad'>Buy now<p>{LONG}<p>End.</article>", f"{LONG} End."),
        (f"<article><ul><li class='ad'>Buy<li>Real item</ul><p>{LONG}</p></article>", f"Real item {LONG}"),
        (f"<article><div class='entry-header'><h1>Title</h1></div><div class='related-work'><p>Others.</div><p>{LONG}</article>", f"Title Others. {LONG}"),
        (f"<article><table><tr><td class=ad>Buy<td>Cell<tr><td>{LONG}</table></article>", f"Cell {LONG}"),
        (f"<article><dl><dt class=promo>Buy<dd>Meaning</dl><p>{LONG}</article>", f"Meaning {LONG}"),
        (f"<body><div><a href=/>Home</a> <a href=/n>News</a> <a href=/a>About</a></div><div><h1>Title</h1><p>{LONG}<p>Short.</div>", f"Title {LONG} Short."),
        (f"<div id=content><div><a href=/>Home</a> <a href=/n>News</a></div><p>{LONG}<p>See <a href=/x>this</a>.</div><div>Other things</div>", f"{LONG} See this."),
        (f"<body class='has-sidebar'><div class='page-with-sidebar'><p>{LONG}<p>{LONG}</div><div class='my-sidebar'><p>Side</div>", f"{LONG} {LONG}"),
        (f"<p>{LONG}", LONG),
        ("<div class='ad'>Buy this</div>", ""),
        (f"<nav>Menu</nav><article><header><h1>Title</h1></header><p>{LONG}</p><footer>Foot</footer></article><footer>Foot</footer>", f"Title {LONG}"),
        (f"<article><p>{LONG}</p><section id='comments'><p>{LONG} says a reader.</p></section></article>", LONG),
    ],
)
def test_pages(page, text):
    assert main_text(page) == text


def test_scores_choose_the_region(monkeypatch):
    lists = "".join(f"<li><b>Word</b> <i>{k}</i> <u>more</u> words here</li>" for k in range(60))
    page = f"<body><div><ul>{lists}</ul></div><div><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></div>"
    assert main_text(page) == " ".join([LONG] * 3)
    monkeypatch.setattr(html_extract, "ratios", lambda lines: [1.0] * len(lines))
    assert main_text(page) != " ".join([LONG] * 3)


def test_scores_decide_on_doubtful_parts():
    """Within an article a part named 'notice' stays where the text around it is dense."""
    dense = f"<article><p>{LONG * 3}</p><p class='notice'>{LONG}</p><p>{LONG * 3}</p></article>"
    assert main_text(dense).count(LONG) == 7
    sparse = f"<article><p>{LONG * 3}</p>" + "<p>x</p>" * 8 + "<p class='notice'><b>Log</b> <i>in</i></p>" + "<p>y</p>" * 8 + "</article>"
    assert "Log" not in main_text(sparse) and main_text(sparse).count("x") >= 8


def test_extraction_of_odd_tables(spark):
    schema = "page_id long, html string, text string, n_chars string, region int"
    data = [(1, f"<p>{LONG}", "old", "old", 5)] * 2 + [(2, None, "old", "old", 6), (None, "", None, None, None)]
    frame = spark.createDataFrame(data, schema)
    found = extract_text(frame)
    assert found.columns == frame.columns and dict(found.dtypes)["n_chars"] == "bigint"
    assert sorted(rows(found), key=str) == sorted(
        [(1, data[0][1], LONG, len(LONG), 5)] * 2 + [(2, None, "", 0, 6), (None, "", "", 0, None)], key=str
    )
    assert rows(extract_text(frame.where("false"))) == []


# 10 --------------------------------------------------------------------------------------------


def test_choices_leave_no_link_out():
    assert len(simhash.choices(0)) == 20 and all(m.bit_count() in (31, 32, 33) for m in simhash.choices(0))
    rng = np.random.default_rng(3)
    for mask in [0, simhash.choices(0)[7], simhash.choices(simhash.choices(0)[3])[11]]:
        deeper = simhash.choices(mask)
        free = [b for b in range(64) if not mask >> b & 1]
        for _ in range(300):
            away = sum(1 << int(b) for b in rng.choice(free, min(3, len(free)), replace=False))
            assert any(not away & m for m in deeper) and all(m & mask == mask for m in deeper)


@pytest.mark.parametrize("broadcast", [100_000, 0])
def test_large_shards_are_dealt_again(spark, monkeypatch, broadcast):
    monkeypatch.setattr(simhash, "MOST", 20)
    monkeypatch.setattr(simhash, "BROADCAST_SHARDS", broadcast)
    largest, whole = [], simhash.shard_links
    rng = np.random.default_rng(4)
    base = int(rng.integers(0, 2**62))
    prints = {base ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(1, 6), replace=False)) for _ in range(500)}
    prints = sorted(p if p < 2**63 else p - 2**64 for p in prints)
    frame = spark.createDataFrame([(p,) for p in prints], "fingerprint long")
    up = {p: p for p in prints}

    def top(p):
        while up[p] != p:
            p = up[p]
        return p

    near = lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count() <= 3
    for a, b in itertools.combinations(prints, 2):
        if near(a, b):
            up[top(max(a, b))] = top(min(a, b))
    pairs = rows(simhash.links(frame))
    assert pairs and len(pairs) == len(set(pairs))
    mine = {p: p for p in prints}

    def root(p):
        while mine[p] != p:
            p = mine[p]
        return p

    for a, b in pairs:
        mine[root(b)] = root(a)
    groups = collections.defaultdict(set), collections.defaultdict(set)
    for p in prints:
        groups[0][top(p)].add(p)
        groups[1][root(p)].add(p)
    assert sorted(map(sorted, groups[0].values())) == sorted(map(sorted, groups[1].values()))
    assert whole is simhash.shard_links and largest == []


def test_checkpoint_removes_its_shuffles_only(spark):
    """The rows, the frame they came from and the session's setting stay; empty and clashing columns too."""
    from pyspark.sql import functions as F

    from sluicegate.llm.common import CLEANUP, checkpointed

    before = spark.conf.get(CLEANUP, "false")
    counted = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.count("*").alias("n"))
    kept = checkpointed(counted)
    assert spark.conf.get(CLEANUP, "false") == before
    assert sorted(kept.collect()) == sorted(counted.collect())
    assert kept.join(counted, ["k", "n"]).count() == 7
    assert checkpointed(counted.where("n < 0")).count() == 0
    twice = checkpointed(counted.select("k", F.col("n").alias("k")))
    assert twice.columns == ["k", "k"] and twice.count() == 7


def test_the_query_shows_what_repeats_leave(spark, tmp_path):
    """Repeated strings of 400 bytes go from the shown text, shorter ones stay; no character is cut."""
    import hashlib

    import pyarrow.parquet as pq

    rng = np.random.default_rng(2)

    def passage(words, letters):
        return " ".join("".join(map(chr, rng.integers(97, 123, letters))) for _ in range(words))

    long, other, short = passage(60, 7), passage(55, 8), passage(55, 5)
    edge = [passage(30, 6) for _ in range(4)]
    texts = {
        1: f"{edge[0]}A{long}B{edge[1]}",
        2: f"{edge[2]}C{long}D{edge[3]}",
        3: passage(90, 6),
        4: None,
        5: f"é{other}",  # C3 A9 and C2 A9: the repeat begins within a character
        6: f"©{other}ä",
        7: f"E{short}F",
        8: f"G{short}H",
        9: "",
    }
    left = {1: f"{edge[0]}AB{edge[1]}", 2: f"{edge[2]}CD{edge[3]}", 4: "", 5: "é", 6: "©ä"}
    exact = {5: b"\xc3", 6: b"\xc2\xc3\xa4"}
    assert len(short.split()) > 50 and len(short) < 400 <= min(len(long), len(other))
    pq.write_table(pa.table({"doc_id": list(texts), "text": list(texts.values())}), tmp_path / "documents.parquet")
    found = {r.doc_id: r for r in queries.op2_suffix_dedup(spark, str(tmp_path)).collect()}
    assert {i: r.text for i, r in found.items()} == texts | left
    for i, r in found.items():
        kept = exact.get(i, r.text.encode())
        assert r.n_bytes == len((texts[i] or "").encode()) == r.n_removed + len(kept)
        assert r.kept_sha256 == hashlib.sha256(kept).hexdigest()


def test_shown_texts_may_hold_other_bytes(spark):
    frame = spark.sql("select 1L doc_id, cast(unhex('FF8041') as string) text")
    (row,) = suffix_dedup.removed_repeats(frame, kept="left").collect()
    assert (row.n_bytes, row.n_removed, row.left) == (3, 0, "\ufffd\ufffdA")


# F1 of round 3: passages of over 50 words that are under 400 bytes -----------------------------


def brute_passages(texts, words):
    """Words covered by as many that also start anywhere else, and the text without them."""
    import re

    places = [list(re.finditer(rb"[^\x20\x09-\x0D]+", (t or "").encode())) for t in texts]
    lists = [[m.group() for m in p] for p in places]
    count = collections.Counter(tuple(w[i : i + words]) for w in lists for i in range(len(w) - words + 1))
    out = []
    for text, place, found in zip(texts, places, lists):
        gone = np.zeros(len(found) + 1, bool)
        for i in range(len(found) - words + 1):
            if count[tuple(found[i : i + words])] > 1:
                gone[i : i + words] = True
        data, kept, at = (text or "").encode(), [], 0
        for i, m in enumerate(place):
            if gone[i]:
                if not i or not gone[i - 1]:
                    kept.append(data[at : m.start()])
                at = m.end()
        out.append((int(gone.sum()), b"".join([*kept, data[at:]]).decode()))
    return out


@pytest.mark.parametrize("most", [4096, 1])
def test_passages_against_brute_force(spark, most, monkeypatch):
    rng = np.random.default_rng(5)
    letters = "abcdefghijklmnopqrstuvwxyzäé中"

    def some(n, longest):
        return ["".join(rng.choice(list(letters), rng.integers(1, longest + 1))) for _ in range(n)]

    shared = [some(n, longest) for n, longest in ((12, 2), (12, 9), (11, 5), (30, 3), (200, 4))]
    spaces = [" ", "\n", " \t ", "\r\n"]
    texts = [None, "", " \n", "a " * 40, "word", " ".join(shared[0]), " ".join(shared[2])]
    for i in range(40):
        passage = shared[i % 5]
        part = passage[rng.integers(0, 3) :] if i % 2 else passage
        found = [*some(rng.integers(0, 20), 6), *part, *some(rng.integers(0, 20), 6)]
        texts.append(spaces[i % 3 // 2].join(found) if i % 3 else "".join(w + spaces[j % 4] for j, w in enumerate(found)))
    docs = spark.createDataFrame([(i % 45, t) for i, t in enumerate(texts)] + [(46, texts[-1])] * 2, "doc_id long, text string")
    texts += [texts[-1]] * 2
    monkeypatch.setattr(suffix_dedup.repeated_spans, "__defaults__", (400, "doc_id", "text", most))
    found = suffix_dedup.removed_repeats(docs, words=12)
    wanted = sorted((i, *x) for i, x in zip([r.doc_id for r in docs.collect()], brute_passages(texts, 12)))
    assert sorted(rows(found.select("doc_id", "n_passage_words", "text_without_passages"))) == wanted
    plain = suffix_dedup.removed_repeats(docs)
    assert sorted(rows(plain)) == sorted(rows(found.select(plain.columns)))


def test_codes_of_words_do_not_depend_on_their_place():
    table = suffix_dedup.powers(64)
    texts = [b"", b"  ", b"ab c", b"\tc ab\n", b"x" * 200 + b" ab", b"ab " + b"x" * 200, b"\0 \0\0"]
    codes = [np.frombuffer(c, np.uint64).tolist() for c in suffix_dedup.word_codes(texts, table, 64)]
    assert codes[:2] == [[], []] and codes[2] == codes[3][::-1] and codes[4] == codes[5][::-1]
    assert codes[2][0] == codes[4][1] and len({x for c in codes for x in c}) == 5
    assert codes == [np.frombuffer(suffix_dedup.word_codes([t], suffix_dedup.powers(999), 999)[0], np.uint64).tolist() for t in texts[:4]] + codes[4:]


def test_the_query_finds_short_passages_of_over_50_words(spark, tmp_path):
    """51 words of 305 bytes that repeat are found also where their ends are joined to other words; 48 words are not."""
    import pyarrow.parquet as pq

    rng = np.random.default_rng(3)

    def passage(words):
        return " ".join("".join(map(chr, rng.integers(97, 123, 5))) for _ in range(words))

    planted, few, own = passage(51), passage(48), [passage(30) for _ in range(6)]
    texts = [
        f"{own[0]}\n{planted} {own[1]}", f"{own[2]}-{planted}. {own[3]}", f"{own[4]} {few}", f"{few} {own[5]}", passage(90),
    ]
    assert len(planted) == 305
    pq.write_table(pa.table({"doc_id": range(5), "text": texts}), tmp_path / "documents.parquet")
    found = sorted(queries.op2_suffix_dedup(spark, str(tmp_path)).collect())
    assert [r.n_removed for r in found] == [0] * 5  # the contract's strings have 400 bytes
    assert [r.text for r in found] == texts
    inner = " ".join(planted.split()[1:-1])
    assert [r.n_passage_words for r in found] == [49, 49, 0, 0, 0]
    assert [r.text_without_passages for r in found] == [t.replace(inner, "") for t in texts]
