"""The corpus operators against plain versions, on small and on awkward input."""

from __future__ import annotations

import base64
import hashlib
import math
import random
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

import corpus_pipeline
from dayledger.llm import decontaminate, language, ngram_lm, packing, radix_dedup, simhash, topk, toxicity, url_filter, warc
from dayledger.llm.common import remainder, scratch
from dayledger.llm.queries import RULES, tokenizer_path

WORDS = [a + b for a in "ka lo mi tu re sa".split() for b in "nen rus tal vik".split()]


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) for _ in range(n))


LONG = prose(1, 6000)
AWKWARD = [
    (1, None),
    (2, ""),
    (3, prose(2, 60)),
    (4, prose(2, 60)),
    (5, "  \n\t "),
    (6, LONG),
    (7, prose(3, 40) + " " + prose(2, 60) + " " + prose(4, 30)),
    (8, "ß é ı İ Σς 漢字 🎉 <|endoftext|> it's 12,5 x2\u00a0y\u0301 " + prose(5, 20)),
    (9, "…—!!! 123"),
    (10, LONG[:9000] + "é" * 150),
]


@pytest.fixture(scope="module")
def docs(spark):
    """Awkward texts, with columns whose names operators use themselves."""
    rows = [(i, t, "xx" if i % 2 else None, "s", i, 1.5, True) for i, t in AWKWARD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, key string, at long, score double, kind boolean")


@pytest.fixture(scope="module")
def empty(docs):
    return docs.filter("false")


def collected(frame):
    return [row.asDict() for row in frame.collect()]


# URL filter


def test_url_rules_and_awkward_urls(spark):
    urls = [None, "no scheme", "http://A.EXAMPLE.net/en/x?y", "http://example.net", "x://example.com/de/#a", "http://q.org/fr/", "http://notnet/", "http://a.b.net/z"]
    pages = spark.createDataFrame([(i, u, None, "clash") for i, u in enumerate(urls)], "page_id long, url string, html string, host string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in collected(url_filter.filter_urls(pages, RULES))}
    assert got == {
        0: ("", "", None, "allow"),
        1: ("", "", None, "allow"),
        2: ("a.example.net", "/en/x", "example.net/en/", "allow"),
        3: ("example.net", "", None, "allow"),
        4: ("example.com", "/de/", "example.com/de/", "block"),
        5: ("q.org", "/fr/", "org/fr/", "allow"),
        6: ("notnet", "/", None, "allow"),
        7: ("a.b.net", "/z", "net/", "block"),
    }
    assert url_filter.filter_urls(pages.filter("false"), RULES).count() == 0


def test_trust_and_distrust_follow_links_like_a_plain_iteration(spark):
    link = lambda *hosts: "".join(f'<p><a class=x href="https://{h}/">.</a>' for h in hosts)
    rows = [("http://bad.net/", link("worse.xx")), ("http://fan.yy/1", link("bad.net", "bad.net")), ("http://fan.yy/2", None), ("http://good.org/fr/", link("friend.yy", "fan.yy")), ("http://friend.yy/", link("fan.yy")), ("http://worse.xx/", "")]
    pages = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(rows)], "page_id long, url string, html string")
    settings = url_filter.Settings(rounds=9, threshold=0.2)
    got = {r["host"]: (r["trust"], r["distrust"], r["verdict"]) for r in collected(url_filter.filter_urls(pages, RULES, settings))}
    links = {("bad.net", "worse.xx"): 1, ("fan.yy", "bad.net"): 2, ("good.org", "friend.yy"): 1, ("good.org", "fan.yy"): 1, ("friend.yy", "fan.yy"): 1}

    def plain(links, seeds):
        hosts = {h for pair in links for h in pair}
        out = Counter()
        for (a, _), n in links.items():
            out[a] += n
        rank = {h: seeds.get(h, 0) for h in hosts}
        for _ in range(settings.rounds):
            flow = Counter()
            for (a, b), n in links.items():
                flow[b] += rank[a] * n / out[a]
            rank = {h: (seeds.get(h, 0) if not out[h] else 0.15 * seeds.get(h, 0)) + 0.85 * flow[h] for h in hosts}
        return rank

    trust, distrust = plain(links, {"good.org": 1}), plain({(b, a): n for (a, b), n in links.items()}, {"bad.net": 1})
    for host, (t, d, _) in got.items():
        assert math.isclose(t, trust[host], abs_tol=1e-12) and math.isclose(d, distrust[host], abs_tol=1e-12)
    assert got["fan.yy"][2] == ("block" if distrust["fan.yy"] > trust["fan.yy"] and distrust["fan.yy"] >= 0.4 else "allow")
    assert got["worse.xx"][2] == "allow"


def test_distrust_settles_on_long_chains_and_cycles(spark):
    chain = ["bad.net", *(f"h{i}" for i in range(1, 21))]
    links = [(b, a, 1) for a, b in zip(chain, chain[1:], strict=False)] + [("c1", "bad.net", 1), ("c1", "c2", 1), ("c2", "c1", 1)]
    pages = {"bad.net": 2000, "h12": 100}
    judged = [(h, "block" if h == "bad.net" else None) for h in [*chain, "c1", "c2"] for _ in range(pages.get(h, 1))]
    judged = spark.createDataFrame(judged, "host string, rule_verdict string")
    got = url_filter.judge_hosts(judged, spark.createDataFrame(links, "src string, dst string, n long"), url_filter.Settings(settled=0.01))
    got = {r["host"]: (r["distrust"], r["host_verdict"]) for r in collected(got)}
    expected = {f"h{i}": 150 * 0.85**i for i in range(1, 21)}
    expected |= {"c1": 150 * 0.85 / (1 - 0.85**2), "c2": 150 * 0.85**2 / (1 - 0.85**2)}
    assert all(abs(got[h][0] - d) <= 0.01 for h, d in expected.items())
    assert all(got[h][1] == ("allow" if h == "h12" else "block") for h in expected)


# Language-model scoring


@pytest.mark.parametrize("order", [2, 3])
def test_scores_equal_a_plain_model(spark, docs, order):
    settings = ngram_lm.Settings(order=order, block_bytes=3000, shard_tokens=500)
    training = remainder(F.col("doc_id"), 5) != 1
    got = {r["doc_id"]: r for r in collected(ngram_lm.score(docs, training, settings))}
    split = {i: ["<s>", *(t or "").encode().lower().split(), "</s>"] for i, t in AWKWARD}
    counts = [Counter() for _ in range(order + 1)]
    for i, words in split.items():
        if zlib.crc32(str(i).encode()) % 5 != 1:
            for k in range(1, order + 1):
                counts[k].update(tuple(words[j : j + k]) for j in range(len(words) - k + 1))
    n = sum(v for k, v in counts[1].items() if k != ("<s>",))
    v = len(counts[1]) - 1
    shares = {k: min(0.95, 1 - sum(c == 1 for c in counts[k].values()) / sum(counts[k].values())) for k in range(2, order + 1)}

    def p(h, w):
        if not h:
            return (counts[1][(w,)] + 0.5) / (n + 0.5 * (v + 1))
        if not counts[len(h)][h]:
            return p(h[1:], w)
        s = shares[len(h) + 1]
        return s * counts[len(h) + 1][(*h, w)] / counts[len(h)][h] + (1 - s) * p(h[1:], w)

    assert len(got) == len(AWKWARD)
    for i, words in split.items():
        assert math.isclose(got[i]["score"], sum(math.log10(p(tuple(words[max(0, j - order + 1) : j]), words[j])) for j in range(1, len(words))), rel_tol=1e-9)
        assert math.isclose(got[i]["base_score"], sum(math.log10(p((), w)) for w in words[1:]), rel_tol=1e-9)
        assert got[i]["n_tokens"] == len(words) - 1 and got[i]["train_tokens"] == n
        assert got[i]["n_known"] == sum(counts[1][(w,)] > 0 for w in words[1:])


def test_scores_without_rows_or_training(docs, empty):
    assert ngram_lm.score(empty, F.lit(True)).count() == 0
    assert {r["train_tokens"] for r in collected(ngram_lm.score(docs, F.lit(False)))} == {0}


def test_sorted_hashes_survive_packing():
    values = np.unique(np.random.default_rng(0).integers(0, 1 << 64, 999, dtype=np.uint64))
    assert (ngram_lm.unpack_sorted(ngram_lm.pack_sorted(values)) == values).all()


# Language


def test_languages_are_learned_and_letterless_texts_are_undetermined(spark, docs):
    stems = {"aa": "oru tano belu".split(), "bb": "schik wrent zolk".split()}
    rows = []
    for i in range(400):
        lang = "aa" if i % 2 else "bb"
        rng = random.Random(i)
        rows.append((i, " ".join(rng.choice(stems[lang]) + rng.choice(["", "s", "en"]) for _ in range(20)), lang))
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.train(frame.filter("doc_id < 300"))
    said = collected(language.predict(frame.filter("doc_id >= 300"), model, ["doc_id", "lang"]))
    assert sum(r["lang"] == r["lang_pred"] for r in said) >= 98
    odd = {r["doc_id"]: r for r in collected(language.predict(docs, model, ["doc_id"]))}
    assert {i for i, r in odd.items() if r["lang_pred"] == "und"} == {1, 2, 5, 9}
    assert all(0 <= r["score"] <= 1 for r in odd.values())
    kept = language.accepted(docs, model)
    assert kept.columns == docs.columns and not {1, 2, 5, 9} & {r["doc_id"] for r in collected(kept)}


def test_language_without_labels(docs, empty):
    model = language.train(empty)
    assert {r["lang_pred"] for r in collected(language.predict(docs, model, ["doc_id"]))} == {"und"}


def test_every_label_can_be_learned_and_the_sample_is_bounded(spark):
    rng = random.Random(8)
    rows = [(230 * i + n, " ".join(f"{rng.choice('bdfgk')}{chr(0x100 + n)}{chr(0x100 + n)}" for _ in range(12)), f"l{n}") for n in range(230) for i in range(9)]
    frame = spark.createDataFrame([*rows, *(row for row in rows if row[0] < 50)], "doc_id long, text string, lang string")
    model = language.train(frame)
    assert len(model.languages) == 230
    assert abs(language.sample(frame, "doc_id", language.Settings(rows=500)).count() - 500) < 120
    twice = collected(language.predict(frame.filter("doc_id < 50"), model, ["doc_id"]))
    assert len(twice) == 100 and len({(r["doc_id"], r["lang_pred"], r["score"]) for r in twice}) == 50


def test_gram_counts_do_not_depend_on_stretches(monkeypatch):
    text = (prose(9, 50) + " ßéλ").encode()
    whole = language.gram_counts(text, 1024)
    monkeypatch.setattr(language, "_STRETCH", 7)
    assert (language.gram_counts(text, 1024) == whole).all()


# Decontamination


def test_reparameterised_questions_are_found_and_clashing_ones_are_not(spark, docs):
    item = "If Tom has 12 apples and gives 5 apples to Anna, how many apples does Tom have left over now?"
    asked = "Well. If Bob has 30 apples and gives 7 apples to Eve, how many apples does Bob have left over now? Yes"
    clash = asked.replace("does Bob", "does Zed")
    texts = [(1, item.lower()), (2, asked), (3, clash), (4, None), (5, ""), (6, prose(1, 90)), (2, asked)]
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    items = spark.createDataFrame([(0, item), (1, "ab cd"), (2, None), (3, item)], "item_id long, text string")
    got = [(r["doc_id"], r["contaminated"], r["item_id"], r["reworded"]) for r in collected(decontaminate.decontaminate(frame, items))]
    expected = [(1, True, 0, False), (2, True, 0, True), (2, True, 0, True), (3, False, None, None), (4, False, None, None), (5, False, None, None), (6, False, None, None)]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    assert not any(r["contaminated"] for r in collected(decontaminate.decontaminate(docs, items.filter("false"))))
    assert decontaminate.decontaminate(docs.filter("false"), items).count() == 0


def test_whole_items_in_long_texts_are_found_like_a_plain_search(spark):
    items = [(i, prose(100 + i, 12 + i)) for i in range(8)]
    texts = [(i, prose(200 + i, 300) + " " + (items[i % 8][1] if i % 3 == 0 else "") + " " + prose(300 + i, 50)) for i in range(30)]
    found = decontaminate.decontaminate(spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"]) for r in collected(found) if r["contaminated"]} == {(i, i % 8) for i in range(0, 30, 3)}


def test_items_keep_the_windows_they_share(spark):
    start = "which of the following statements about the "
    items = [(0, start + "lonus rimak telok basan firud"), (1, start + "gavon pirel dosik munat"), (2, "ka lo mi tu re sa ne vi " * 3), (3, start + "gavon pirel dosik munat")]
    texts = [(i, "nen " * 9 + items[i][1] + " rus" * 9) for i in range(3)] + [(7, "nen " * 9 + start + "rus" * 9)]
    found = decontaminate.decontaminate(spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {r["doc_id"]: r["item_id"] for r in collected(found)} == {0: 0, 1: 1, 2: 2, 7: None}


def test_names_at_the_start_of_sentences_are_slots(spark):
    items = [(0, "Anna has 12 apples and gives 3 to Ben today."), (1, "Tom has 12 apples. Anna has 5 pears. Ben eats 3 of them. Tom gives 2 to Anna."), (2, "Tales are told in the old town of Brakel")]
    texts = [
        (0, "Carla has 30 apples and gives 7 to Dan today."),
        (1, "So be it. Max has 30 apples. Eve has 8 pears. Dan eats 4 of them. Max gives 6 to Eve. Yes."),
        (2, "Max has 30 apples. Eve has 8 pears. Dan eats 4 of them. Dan gives 6 to Eve."),
        (3, "Nobody has 30 apples and gives 7 to Dan today. But nobody knows."),
        (4, "Songs are told in the old town of Brakel. They sing songs."),
    ]
    found = decontaminate.decontaminate(spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {r["doc_id"]: (r["item_id"], r["reworded"]) for r in collected(found)} == {0: (0, True), 1: (1, True), 2: (None, None), 3: (None, None), 4: (None, None)}


def test_documents_are_told_apart_by_text_and_awkward_ones_match_nothing(spark, docs):
    item, clean = prose(500, 25), prose(501, 90)
    items = spark.createDataFrame([(1, item, "x"), (2, None, "x"), (3, "", "x"), (1, item, "x")], "item_id long, text string, doc_id string")
    rows = spark.createDataFrame([(None, item), (None, clean), (7, item), (7, clean), (7, item), (8, prose(502, 40_000) + " " + item)], "doc_id long, text string")
    got = [(r["doc_id"], r["contaminated"], r["item_id"]) for r in collected(decontaminate.decontaminate(rows, items))]
    assert Counter(got) == Counter([(None, True, 1), (None, False, None), (7, True, 1), (7, False, None), (7, True, 1), (8, True, 1)])
    real = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    got = collected(decontaminate.decontaminate(docs, real))
    assert sorted(r["doc_id"] for r in got) == sorted(i for i, _ in AWKWARD) and not any(r["contaminated"] for r in got)


def test_words_are_read_like_plain_ones():
    known = decontaminate.Tokens()
    for word in "Anna, anna Two. KG km: x a. (b) 12,5 don't É é; Dr.! ... u.s. The the".split():
        value, exact, kind, ends, opener = known._read(word.encode())
        core = decontaminate._EDGES.sub("", word).lower()
        assert opener == (core in decontaminate.OPENERS.split()) and ends == (word[-1] in ".!?:" or word[-2:-1] in ".!?")
        assert (kind == decontaminate._NAME) == (word.strip(",.!()")[:1].isupper() and core not in ("two", "kg"))


def test_items_of_numbers_short_items_and_texts_without_blanks_are_found_in_exact_copies(spark):
    items = [(0, "What is 12 + 34 * 5 - 6 / 7?"), (1, "Define entropy."), (2, "中国的首都是哪里请从下面选择"), (3, "12 km = 12000 m, 3 h = 180 min, 5 kg = 5000 g")]
    texts = [
        (0, "Task: What is 12 + 34 * 5 - 6 / 7? Solve it."),
        (1, "Task: What is 12 - 34 * 5 + 6 / 7? Solve it."),
        (2, "Task: What is 12 + 34 * 5 - 6 / 8? Solve it."),
        (3, "First define entropy, then go on."),
        (4, "问题：中国的首都是哪里？请从下面选择。"),
        (5, "中国的人口是多少？请从上面选择。"),
        (6, "table 12 km = 12000 m, 3 h = 180 min, 5 kg = 5000 g end"),
        (7, "define what entropy is"),
    ]
    found = decontaminate.decontaminate(spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {r["doc_id"]: (r["item_id"], r["reworded"]) for r in collected(found) if r["contaminated"]} == {0: (0, False), 3: (1, False), 4: (2, False), 6: (3, False)}


# Packing


def test_ids_and_places_equal_the_tokenizers(spark, docs, empty):
    from tokenizers import Tokenizer

    pieces = collected(packing.pack_documents(docs, tokenizer_path(), 2, capacity=64))
    tokenizer = Tokenizer.from_file(tokenizer_path())
    for i, text in AWKWARD:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], dtype="<u4")
        own = sorted((p for p in pieces if p["doc_id"] == i), key=lambda p: p["start"])
        assert [p["start"] for p in own] == [sum(q["length"] for q in own[:k]) for k in range(len(own))]
        assert sum(p["length"] for p in own) == len(ids)
        assert all(p["doc_tokens"] == len(ids) and p["ids_crc32"] == zlib.crc32(ids[p["start"] : p["start"] + p["length"]].tobytes()) for p in own)
    by = {}
    for p in pieces:
        by.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for spans in by.values():
        spans.sort()
        assert [o for o, _ in spans] == [sum(n for _, n in spans[:k]) for k in range(len(spans))] and sum(n for _, n in spans) <= 64
    assert packing.pack_documents(empty, tokenizer_path(), 2).count() == 0


def test_texts_without_ids_are_dealt_to_all_groups(spark):
    pieces = spark.range(0, 20_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("start"), (1 + F.col("id") % 90).alias("length"), F.lit(1).cast("long").alias("ids_crc32"), F.lit(9).cast("long").alias("doc_tokens"), F.col("id").alias("number"))
    packed = packing.pack(pieces, capacity=100, group_pieces=1000)
    sizes = [r["count"] for r in packed.groupBy(F.shiftright("sequence_id", 32)).count().collect()]
    assert len(sizes) == 20 and sum(sizes) == 20_000 and max(sizes) < 1300


def test_the_tournament_packs_like_plain_first_fit():
    rng = random.Random(0)
    lengths = sorted((rng.randint(1, 50) for _ in range(300)), reverse=True)
    room, plain = [], []
    for n in lengths:
        at = next((i for i, r in enumerate(room) if r >= n), len(room))
        if at == len(room):
            room.append(50)
        plain.append((at, 50 - room[at]))
        room[at] -= n
    assert list(zip(*packing.first_fit_decreasing(lengths, 50), strict=True)) == plain


# Top-k search


@pytest.mark.parametrize("bins", [4, 256])
def test_top_k_equals_a_plain_sort(spark, bins):
    rng = np.random.default_rng(1)
    vectors = [list(map(float, rng.normal(size=6).round(2))) for _ in range(60)]
    vectors[7:30] = [vectors[3]] * 23  # ties
    rows = [(i, v, 0) for i, v in enumerate(vectors)] + [(100, None, 0), (120, [1.0, None] * 3, 0), (140, [float("nan")] * 6, 0), (160, [1.0, 2.0], 0), (180, [3.0, 4.0], 0), (200, [], 0)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, block int")
    settings = topk.Settings(k=5, bins=bins, query_block=2, candidate_block=16)
    got = {}
    for r in collected(topk.top_k(frame, F.col("vec_id") % 20 == 0, settings)):
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    good = {i: [math.floor(64 * x) for x in v] for i, v, _ in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)}
    for q in (i for i in good if i % 20 == 0):
        best = sorted((-sum(a * b for a, b in zip(good[q], c, strict=True)), i) for i, c in good.items() if i != q and len(c) == len(good[q]))[:5]
        assert sorted(got.get(q, [])) == [(n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert topk.top_k(frame.filter("false"), F.col("vec_id") % 20 == 0).count() == 0


def plain_top_k(rows, k):
    """{query id: [(score, id)]}: the k best of the candidates of all rows with that id."""
    good = [(i, [math.floor(64 * x) for x in v]) for i, v in rows]
    best = {}
    for q, v in (x for x in good if x[0] % 20 == 0):
        best.setdefault(q, []).extend((-sum(a * b for a, b in zip(v, c, strict=True)), i) for i, c in good if i != q and len(c) == len(v))
    return {q: [(-s, i) for s, i in sorted(found)[:k]] for q, found in best.items() if found}


def ranked_top_k(frame, settings):
    got = {}
    for r in sorted(collected(topk.top_k(frame, F.col("vec_id") % 20 == 0, settings)), key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
    return got


def test_top_k_broadcasts_no_copies_of_its_queries(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=64).round(3)]) for i in range(2000)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    # A copy of the 100 queries has 50 kB, one for each of the 63 blocks 3 MB.
    spark.conf.set("spark.sql.maxBroadcastTableSize", "1m")
    try:
        got = ranked_top_k(frame, topk.Settings(candidate_block=32))
    finally:
        spark.conf.unset("spark.sql.maxBroadcastTableSize")
    assert got == plain_top_k(rows, 20)


def test_top_k_of_many_groups_and_slices_and_of_scores_of_all_sizes(spark, monkeypatch):
    rng = np.random.default_rng(3)
    kinds = [(6, 1), (3, 100), (2, 10**7)]  # lengths, and sizes whose scores 32, 64 and no bits of a float hold exactly
    rows = [(int(rng.integers(0, 120)), [float(x) for x in (rng.normal(size=kinds[i % 3][0]) * kinds[i % 3][1]).round(2)]) for i in range(160)]
    rows += [(20 * i, [0.5] * 6) for i in range(8)] + [(500 + i, [0.5] * 6) for i in range(40)]  # ids that repeat, and ties
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    monkeypatch.setattr(topk, "WORK", 1)
    assert ranked_top_k(frame, topk.Settings(k=5, query_block=4, candidate_block=16)) == plain_top_k(rows, 5)


# WARC


@pytest.mark.parametrize("split", [50, 1 << 20])
def test_archives_round_trip(spark, split):
    inner = warc.member(b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 999\r\n\r\nshort", 0).decode("latin-1")
    payloads = [None, "", "same", "same", "é" * 3000, "\x1f\x8b\x08 magic", inner, "same", prose(1, 5000)]
    pages = spark.createDataFrame([(i + 10, f"http://h/{i}\r\nX: y" if i else None, p, "z") for i, p in enumerate(payloads)], "page_id long, url string, html string, digest string")
    folder = scratch(spark, "warc-test")
    settings = warc.Settings(archive_bytes=400, split_bytes=split)
    got = {r["page_id"]: r for r in collected(warc.read(warc.write(pages, folder, settings), folder, settings))}
    listed = {r["page_id"]: r for r in collected(warc.read(warc.archives(spark, folder), folder, settings))}
    assert got == listed and len(got) == len(payloads)
    for i, p in enumerate(payloads):
        data = (p or "").encode()
        first = 10 + next(j for j, q in enumerate(payloads) if (q or "").encode() == data)
        row = got[i + 10]
        assert row["payload_bytes"] == len(data) and row["payload_digest"] == base64.b32encode(hashlib.sha1(data).digest()).decode()
        assert (row["record_type"], row["refers_to"]) == (("response", None) if first == i + 10 else ("revisit", first))
        assert row["payload"] == (data if first == i + 10 else None)


def test_small_payloads_are_not_revisits_and_no_rows_no_records(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab")], "page_id long, url string, html string")
    folder = scratch(spark, "warc-test")
    settings = warc.Settings(least_bytes=3)
    assert {r["record_type"] for r in collected(warc.read(warc.write(pages, folder, settings), folder))} == {"response"}
    folder = scratch(spark, "warc-test")
    assert warc.read(warc.write(pages.filter("false"), folder), folder).count() == 0


# Suffix dedup


def plain_removal(rows, length=100):
    seen, out = set(), {}
    for i, text in sorted(rows):
        gone = np.zeros(len(text) + 1, dtype=int)
        for p in range(len(text) - length + 1):
            window = text[p : p + length]
            if window in seen:
                gone[p] += 1
                gone[p + length] -= 1
            seen.add(window)
        mask = np.cumsum(gone)[:-1] > 0
        kept = bytes(b for b, m in zip(text, mask, strict=True) if not m)
        spans = int((mask & ~np.concatenate([[False], mask[:-1]])).sum()) if len(text) else 0
        out[i] = (len(text), int(mask.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


def removal(frame):
    return {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in collected(radix_dedup.remove_repeats(frame))}


def test_removal_equals_a_plain_search(spark, docs, empty, monkeypatch):
    rng = random.Random(3)
    passage = prose(7, 30)
    rows = [(i, t or "") for i, t in AWKWARD]
    rows += [(20 + i, prose(50 + i, rng.randint(1, 30)) + rng.choice(["\n", " ", "x"]) + passage[rng.randint(0, 40) :] + rng.choice(["", "y", " z"]) + prose(90 + i, 9)) for i in range(40)]
    rows += [(90, "ab" * 400), (91, "ab" * 300), (92, "a" * 99), (93, "a" * 100), (94, "a" * 101)]
    expected = plain_removal([(i, t.encode()) for i, t in rows])
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert removal(frame) == expected
    assert removal(empty) == {}
    once = spark.createDataFrame([(1, passage), (1, passage), (None, passage)], "doc_id long, text string")
    got = collected(radix_dedup.remove_repeats(once, with_text=True))
    assert sorted((r["doc_id"] or 0, r["kept"]) for r in got) == [(0, passage), (1, ""), (1, "")]


def test_different_texts_of_one_doc_id_are_different_documents(spark):
    passage, other = prose(7, 30), prose(8, 30)
    rows = [(None, passage + " x " + prose(12, 20)), (None, other + " y " + passage), (5, other), (5, prose(13, 30)), (6, prose(14, 30)), (None, other + " y " + passage)]
    key = lambda text: radix_dedup._text_key(text.encode())
    order = sorted(set(rows), key=lambda r: (r[0] or 0, key(r[1])))
    plain = plain_removal([(i, text.encode()) for i, (_, text) in enumerate(order)])
    expected = sorted(((r[0] or 0, *plain[order.index(r)]) for r in rows), key=repr)
    got = collected(radix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)))
    assert sorted(((r["doc_id"] or 0, r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got), key=repr) == expected


def test_runs_do_not_depend_on_stretches(monkeypatch):
    text = prose(11, 400).encode()
    cover = lambda found: sorted(p for s, n in zip(found[1].tolist(), found[2].tolist(), strict=True) for p in range(s, s + n + 1))
    whole = cover(radix_dedup.runs([text]))
    monkeypatch.setattr(radix_dedup, "_STRETCH", 130)
    assert cover(radix_dedup.runs([text])) == whole == list(range(len(text) - 99))


def test_tasks_are_sent_few_texts_at_once(spark, monkeypatch):
    name, first_pass, second_visit = "spark.sql.execution.arrow.maxRecordsPerBatch", radix_dedup._first_pass, radix_dedup._second_visit

    def bounded(step):
        def run(batches):
            def checked():
                for batch in batches:
                    assert batch.num_rows <= 1024
                    yield batch

            yield from step(checked())

        return run

    monkeypatch.setattr(radix_dedup, "_first_pass", lambda length: bounded(first_pass(length)))
    monkeypatch.setattr(radix_dedup, "_second_visit", lambda length, with_text: bounded(second_visit(length, with_text)))
    before = spark.conf.get(name)
    rows = [(i, f"{i} " + prose(i % 5, 20)) for i in range(4000)]
    assert removal(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)) == plain_removal([(i, t.encode()) for i, t in rows])
    assert spark.conf.get(name) == before


def test_texts_that_are_no_valid_utf8_keep_their_bytes(spark):
    shared = bytes(range(256)) * 2
    rows = [(1, b"a" + shared), (2, shared + b"\xff\xfe"), (3, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text binary").selectExpr("doc_id", "cast(text as string) as text")
    assert removal(frame) == plain_removal([(i, t or b"") for i, t in rows])


# SimHash


def plain_fingerprint(text: str | None) -> int:
    from xxhash import xxh64_intdigest

    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    values = [xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))


def test_fingerprints_equal_plain_ones(docs, monkeypatch):
    monkeypatch.setattr(simhash, "_STRETCH", 50)
    for _, text in AWKWARD:
        assert simhash.fingerprint((text or "").encode()) == plain_fingerprint(text)


@pytest.mark.parametrize(("bits", "crowded"), [(3, 512), (3, 4), (5, 512), (7, 4)])
def test_links_connect_what_a_plain_comparison_connects(spark, bits, crowded):
    rng = random.Random(bits)
    values = {0}
    for _ in range(12):
        value = rng.getrandbits(64)
        for _ in range(25):
            values.add(value)
            for _ in range(rng.randint(1, bits + 1)):
                value ^= 1 << rng.randrange(64)
    nodes = sorted(values)
    parent = {v: v for v in nodes}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if (a ^ b).bit_count() <= bits:
                parent[max(root(a), root(b))] = min(root(a), root(b))
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    frame = spark.createDataFrame([(signed(v),) for v in nodes], "fp long")
    found = {r["node"]: r["root"] for r in collected(simhash.components(simhash.links(frame, bits, crowded)))}
    groups, plain = {}, {}
    for v in nodes:
        groups.setdefault(found.get(signed(v), signed(v)), set()).add(v)
        plain.setdefault(root(v), set()).add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, plain.values()))


def test_near_duplicates_of_awkward_rows(docs, empty):
    got = {r["doc_id"]: r for r in collected(simhash.near_duplicates(docs))}
    assert {i for i, r in got.items() if r["component_id"] == 1} == {1, 2, 5} and got[1]["fingerprint"] == "0" * 16
    assert got[4]["component_id"] == 3
    assert {i: r["fingerprint"] for i, r in got.items()} == {i: f"{plain_fingerprint(t):016x}" for i, t in AWKWARD}
    assert simhash.near_duplicates(empty).count() == 0


# Toxicity


def test_toxic_words_are_learned(spark, docs, empty):
    rows, labels = [], []
    for i in range(400):
        toxic = i % 5 == 0
        insult = random.Random(i).choice(["vrakol", "vrakos", "idiot"]) if toxic else ""
        rows.append((i, prose(i, 30) + " " + insult + " " + prose(i + 999, 20)))
        labels.append((i, 1, int(toxic)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.train(frame, known.filter("doc_id < 300"))
    said = {r["doc_id"]: r for r in collected(toxicity.score(frame, model))}
    assert all(said[i]["predicted"] == int(i % 5 == 0) for i in range(300, 400))
    odd = collected(toxicity.score(docs, model))
    assert len(odd) == len(AWKWARD) and all(0 <= r["score"] < 0.5 for r in odd)
    assert toxicity.score(empty, model).count() == 0


def test_without_labels_the_lexicon_decides(spark, empty):
    none = spark.createDataFrame([(1, 1, None)], "doc_id long, quality int, toxic int")
    model = toxicity.train(empty, none)
    frame = spark.createDataFrame([(1, "you idiot"), (2, "you there"), (3, None)], "doc_id long, text string")
    assert {r["doc_id"]: r["predicted"] for r in collected(toxicity.score(frame, model))} == {1: 1, 2: 0, 3: 0}


# Pipeline


def test_stages_keep_the_columns_and_what_is_clean(spark, tmp_path):
    benchmark = prose(500, 25)
    passage = prose(501, 60)
    texts = [prose(i, 120) for i in range(40)]
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(50, texts[4]), (51, texts[5] + " new"), (52, prose(60, 80) + " " + benchmark + " " + prose(61, 80)), (53, prose(62, 90) + " " + passage), (54, passage + " " + prose(63, 90)), (55, "1234 !!"), (56, None)]
    frame = spark.createDataFrame([(i, t, "en" if i % 2 else "fr", "s", len(t or ""), "extra") for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, `at` string")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, benchmark)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = frame
    ids = [None, None, None, None]
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES[:4]):
        kept = spark.createDataFrame(stage(spark, kept, str(tmp_path)).collect(), frame.schema)
        ids[n] = {r["doc_id"] for r in collected(kept)}
        assert kept.columns == frame.columns
    clean = set(range(40))
    assert ids[0] >= clean | {50, 51, 52, 53, 54} and not ids[0] & {55, 56}
    assert 50 not in ids[1] and ids[1] >= clean | {52, 53, 54}
    assert ids[2] == ids[1]
    assert passage[60:-60] not in {r["doc_id"]: r["text"] for r in collected(kept)}[54]
    assert ids[3] == ids[2] - {52}
    packed = collected(corpus_pipeline.run(spark, str(tmp_path)))
    assert {p["doc_id"] for p in packed} == ids[3]


def test_stages_of_an_empty_table_and_of_columns_with_the_names_of_their_own(spark, tmp_path):
    clash = "row key id cut_id cut_text cut_key first_id first_key leak own_key kept_key text_key fp".split()
    rows = [(i, prose(i, 100), 1, *range(len(clash))) for i in range(4)] + [(9, prose(1, 100), 1, *range(len(clash)))]
    frame = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, " + ", ".join(f"{c} long" for c in clash))
    spark.createDataFrame([(0, prose(500, 25))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for _, stage in corpus_pipeline.STAGES[1:4]:
        got = stage(spark, frame, str(tmp_path))
        assert got.columns == frame.columns and {tuple(r)[3:] for r in got.collect()} == {tuple(range(len(clash)))}
    frame.filter("false").withColumn("lang", F.lit(None).cast("string")).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_stages_keep_different_texts_without_a_doc_id(spark, tmp_path):
    benchmark = prose(500, 25)
    texts = [prose(i, 120) for i in range(700, 706)] + [prose(60, 80) + " " + benchmark + " " + prose(61, 80)]
    rows = [(None, t) for t in [*texts, texts[0]]] + [(3, texts[1]), (3, prose(710, 120)), (9, texts[2])]
    frame = spark.createDataFrame([(i, t, len(t)) for i, t in rows], "doc_id long, text string, n_chars long")
    spark.createDataFrame([(0, benchmark)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept, expected = frame, {(None, t) for t in [texts[0], *texts[3:]]} | {(3, texts[1]), (3, prose(710, 120)), (9, texts[2])}
    for _, stage in corpus_pipeline.STAGES[1:4]:
        kept = spark.createDataFrame(stage(spark, kept, str(tmp_path)).collect(), frame.schema)
        got = [(r["doc_id"], r["text"]) for r in collected(kept)]
        assert set(got) == expected - ({(None, texts[6])} if stage is corpus_pipeline.drop_contaminated else set()) and len(got) == len(set(got))


def test_a_task_holds_a_small_part_of_its_texts():
    """Peak of what a task allocates over 12 MB of text, without its input: windows of documents, and runs of repeated passages."""
    rng = np.random.default_rng(5)
    words = ["".join(map(chr, rng.integers(97, 123, 5))) for _ in range(2000)]
    texts = [" ".join(words[i] for i in rng.integers(0, 2000, 500)) for _ in range(4000)]
    bitmap = np.zeros(1 << (decontaminate._BITS - 6), dtype=np.uint64)
    steps = {"id": (decontaminate._document_windows([8], bitmap, decontaminate.Settings()), 40), "doc_id": (radix_dedup._first_pass(radix_dedup.LENGTH), 65)}
    for key, (step, most) in steps.items():
        batch = pa.RecordBatch.from_pydict({key: list(range(len(texts))), "text": texts})
        tracemalloc.start()
        for _ in step(iter([batch])):
            pass
        peak = tracemalloc.get_traced_memory()[1] / 1e6
        tracemalloc.stop()
        assert peak < most, (key, peak)


def test_a_visit_holds_few_blocks_as_objects():
    """Peak of what a visit allocates over 2 MB of text whose runs are all undecided, without its input."""
    rng = np.random.default_rng(6)
    texts = [rng.integers(97, 123, 2000, dtype=np.uint8).tobytes() for _ in range(1000)]
    found = radix_dedup.runs(texts)
    undecided = [[] for _ in texts]
    for number, at, span, lead, key, _ in zip(*(c.tolist() for c in found), strict=True):
        undecided[number].append({"at": at, "span": span, "lead": lead, "key": key})
    columns = {"doc": list(range(len(texts))), "packed": [zstandard.compress(t) for t in texts], "spans": [None] * len(texts), "runs": undecided}
    spans = pa.list_(pa.struct([("at", pa.int64()), ("to", pa.int64())]))
    batch = pa.RecordBatch.from_arrays([pa.array(v, spans) if k == "spans" else pa.array(v) for k, v in columns.items()], list(columns))
    del undecided, columns
    tracemalloc.start()
    rows = sum(part.num_rows for part in radix_dedup._second_visit(radix_dedup.LENGTH, False)(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    assert rows > 250_000 and peak < 90, (rows, peak)
