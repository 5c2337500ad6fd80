"""The Jaccard join, the detection of periodic runs and the prefix trie against plain versions."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import __spark_entry__ as contract
from dayledger.llm import jaccard, periodic, queries, turn_trie
from dayledger.llm.common import stored

SMALL = "/root/testdata/sf0.001"
VOCABULARY = [a + b for a in "ka lo mi tu re sa".split() for b in "nen rus tal vik".split()]


def prose(rng: random.Random, n: int) -> list[str]:
    return [rng.choice(VOCABULARY) for _ in range(n)]


# Jaccard join


def plain_components(rows, width=5, percent=80):
    """(doc_id, set size, least id reachable) by counting the intersections of all pairs that share an n-gram."""
    sets = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        sets.append(frozenset(tuple(words[j : j + width]) for j in range(max(1, len(words) - width + 1))) if words else frozenset())
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    holders = defaultdict(list)
    for i, own in enumerate(sets):
        shared = Counter(j for gram in own for j in holders[gram])
        for j, n in shared.items():
            if 100 * n >= percent * (len(own) + len(sets[j]) - n):
                parent[max(root(i), root(j))] = min(root(i), root(j))
        for gram in own:
            holders[gram].append(i)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[root(i)].append(rows[i][0])
    least = {r: min((d for d in ids if d is not None), default=None) for r, ids in groups.items()}
    return [(rows[i][0], len(sets[i]), least[root(i)] if sets[i] else rows[i][0]) for i in range(len(rows))]


def awkward_rows():
    rng = random.Random(11)
    base, line = prose(rng, 120), prose(rng, 40)
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, None), (5, "one two"), (6, "ONE\ttwo"), (7, "two one"), (None, " ".join(line)), (None, " ".join(base)), (9, " ".join(line)), (9, "é İ x y z w"), (9, "é İ x y z w")]
    for i in range(60):  # near copies of one text, some of them only near to some
        words = list(base)
        for _ in range(rng.randint(0, 6)):
            words[rng.randrange(len(words))] = f"w{rng.randrange(9)}"
        rows.append((100 + i, " ".join(words[: 120 - rng.choice((0, 0, 20, 45))])))
    for i in range(40):  # a common line in texts that are not alike
        rows.append((200 + i, " ".join(line + prose(rng, rng.choice((2, 8, 15, 60))))))
    rows += [(300, " ".join(prose(rng, 30_000))), (301, " ".join(["again"] * 5000))]
    return [*rows, rows[20], rows[70]]


@pytest.mark.parametrize("stars,block", [(2, 1024), (0, 1024), (1, 7)])
def test_links_equal_a_plain_join(spark, monkeypatch, stars, block):
    rows = awkward_rows()
    monkeypatch.setattr(jaccard, "_GATHERED", 20_000)
    docs = spark.createDataFrame([(*row, "clash", 1, 2) for row in rows], "doc_id long, text string, node string, n long, root long")
    got = [tuple(row) for row in jaccard.join(docs, stars=stars, block=block).collect()]
    key = lambda row: str(row)
    assert sorted(got, key=key) == sorted(plain_components(rows), key=key)


def near_copies(n):
    """Copies of one text with one to six other words: many link with none, all share most n-grams."""
    rng = random.Random(21)
    base = [f"b{i}" for i in range(150)]
    rows = []
    for i in range(n):
        words = list(base)
        for at in rng.sample(range(150), rng.randint(1, 6)):
            words[at] = f"x{i}_{at}"
        rows.append((i, " ".join(words)))
    return rows


def test_candidates_grow_with_the_rows_of_a_group_not_their_square(spark, monkeypatch):
    rows = near_copies(200)
    candidates, verified = [], jaccard.verified

    def counted(pairs, nodes, percent):
        candidates.append(pairs.count())
        return verified(pairs, nodes, percent)

    monkeypatch.setattr(jaccard, "verified", counted)
    got = [tuple(row) for row in jaccard.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    expected = plain_components(rows)
    alone = [doc for doc, _, least in expected if doc == least]
    assert sorted(got) == sorted(expected) and 40 < len(alone) < 160
    assert sum(candidates) < 8 * len(rows)


@pytest.mark.parametrize("crowded,bits", [(0, 1 << 17), (1, 64), (10_000, 1 << 17)])
def test_links_do_not_depend_on_sketches(spark, monkeypatch, crowded, bits):
    rows = awkward_rows() + [(doc + 1000, text) for doc, text in near_copies(60)]
    monkeypatch.setattr(jaccard, "CROWDED", crowded)
    monkeypatch.setattr(jaccard, "SKETCH_BITS", bits)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(row) for row in jaccard.join(docs, stars=0, block=16).collect()]
    key = lambda row: str(row)
    assert sorted(got, key=key) == sorted(plain_components(rows), key=key)


def test_sketches_never_differ_more_than_sets():
    rng = np.random.default_rng(8)
    for size in (1, 9, 100, 130, 3000, 50_000):
        a = np.unique(rng.integers(0, 1 << 50, size))
        for dropped, added in ((0, 0), (size // 9, size // 9), (0, size // 4), (size, size)):
            b = np.unique(np.concatenate([a[dropped:], rng.integers(0, 1 << 50, added)]))
            for bits in (64, 1 << 17):
                one, other = (np.frombuffer(jaccard.sketch(x, bits), dtype="<u8") for x in (a, b))
                differ = int(jaccard.apart(one, np.stack([other, other]))[0])
                assert differ <= len(np.setxor1d(a, b)) and differ % 2 == len(np.setxor1d(a, b)) % 2
    assert len(jaccard.sketch(np.arange(16), 64)) == 8 and len(jaccard.sketch(np.arange(17), 1 << 17)) == 16


def test_an_empty_table_links_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard.join(docs).collect() == []


def test_jaccard_query_equals_a_plain_join_on_a_whole_table(spark):
    rows = [tuple(row) for row in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = [tuple(row) for row in contract.queries()["op11_ngram_jaccard"](spark, SMALL).collect()]
    expected = plain_components(rows)
    assert sorted(got) == sorted(expected) and any(row[0] != row[2] for row in expected)


def test_hashes_do_not_depend_on_stretches(monkeypatch):
    text = (" ".join(prose(random.Random(2), 900)) + " \x0b Ab\x1cC D\t" * 9).encode()
    whole = jaccard.shingles(text, 5, jaccard._Hashes())
    monkeypatch.setattr(jaccard, "_STRETCH", 100)
    assert (jaccard.shingles(text, 5, jaccard._Hashes()) == whole).all() and len(whole) > 800


def test_sorted_keys_survive_coding():
    keys = np.array([0, 1, 65534, 65535, 65536, 200_000, 1 << 31, (1 << 32) - 1])
    assert (jaccard.decoded(jaccard.coded(keys)) == keys).all() and len(jaccard.decoded(jaccard.coded(keys[:0]))) == 0


# Periodic runs


def test_rows_of_shards_do_not_swell_with_their_number():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 1 << 64, 400, dtype=np.uint64)) for _ in range(500)]
    nodes, total = np.arange(500), sum(map(len, sets))
    for bits in (4, 12):
        for make, most in ((jaccard._count_rows(bits), 4.1), (jaccard._posting_rows(bits, {}), 6.1)):
            rows = [row for batch in make(nodes, sets) for row in batch.to_pylist() if row["kind"] < 2]
            size = sum(len(row["a"]) + (len(row["b"]) if row["kind"] else 0) for row in rows) / total
            assert size < most, (bits, size)
            owners = sum((np.bincount(jaccard.decoded(row["b"]), minlength=500) for row in rows if row["kind"]), np.zeros(500, dtype=int))
            assert not owners.any() or owners.tolist() == [len(own) for own in sets]



def plain_runs(words, exponent=4, least=6):
    found = {}
    for q in range(1, len(words) // exponent + 1):
        start = None
        for x, same in enumerate([words[i] == words[i + q] for i in range(len(words) - q)] + [False]):
            if same and start is None:
                start = x
            if not same and start is not None:
                if x - start + q >= max(least, exponent * q):
                    found.setdefault((start, x - start + q), q)
                start = None
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda run: (run[0], run[2]))


def plain_row(doc, text):
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(str(doc).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    kept = b" ".join(word for i, word in enumerate(words) if i not in dropped)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    return doc, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest()


def test_runs_equal_a_plain_scan_of_all_periods():
    rng = random.Random(3)
    for _ in range(600):
        words = [rng.randrange(rng.choice((1, 2, 3, 4))) for _ in range(rng.randint(0, 70))]
        if words and rng.random() < 0.5:
            p, a = rng.randint(1, 9), rng.randrange(len(words))
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(len(words))]
        texts = [words, words[::-1], [], words * 5]
        got = periodic.runs_of([np.array(text, dtype=np.int64) for text in texts])
        assert got == [plain_runs(text) for text in texts]


def test_rare_words_split_until_nothing_changes():
    text = np.array([1, 1, 1, 1, 9, 2, 2, 1, 2, 2, 1, 2, 1])
    # 9 splits; then 1 is too rare on the right, and what is left of 2 too short.
    assert periodic.survivors(text, np.zeros(len(text), dtype=np.int64), 4, 4) == [(0, 4)]
    assert periodic.survivors(text, np.zeros(len(text), dtype=np.int64), 4, 5) == []


def test_runs_of_awkward_rows(spark, monkeypatch):
    long = " ".join(prose(random.Random(4), 3000)) + " a b c" * 4000 + " tail"
    rows = [(1, None), (2, ""), (3, " \t"), (None, "x " * 6), (4, "x " * 5), (5, "a b c " * 4), (5, "A a " * 9), (6, long), (6, long)]
    docs = spark.createDataFrame([(*row, 1, "x") for row in rows], "doc_id long, text string, runs long, collapsed string")
    got = {(r["doc_id"], i): r for i, r in enumerate(periodic.find_runs(docs).collect())}
    assert len(got) == len(rows)
    for (doc, i), row in got.items():
        words = (rows[i][1] or "").encode().split()
        runs = plain_runs(words) if len(words) < 2000 else [(3000, 12_000, 3)]
        dropped = {x for s, n, q in runs for x in range(s + q, s + n)}
        assert (doc, row["n_words"], [tuple(run) for run in row["runs"]]) == (rows[i][0], len(words), runs)
        assert row["collapsed"].encode() == b" ".join(word for x, word in enumerate(words) if x not in dropped)
    monkeypatch.setattr(periodic, "_STRETCH", 700)
    known: dict = {}
    assert len(periodic.word_numbers(long.encode(), known)) == 15_001 and periodic._collapsed(long.encode(), [(3000, 12_000, 3)]) == long.split(" a b c a")[0] + " a b c tail"
    assert periodic.find_runs(docs.filter("false")).collect() == []


def test_constant_text_takes_one_run():
    assert periodic.runs_of([np.zeros(60_000, dtype=np.int64)]) == [[(0, 60_000, 1)]]


def test_periodic_query_equals_a_plain_scan(spark, tmp_path):
    rng = random.Random(6)
    rows = [(i, " ".join(prose(rng, rng.randint(0, 90)))) for i in range(300)] + [(300, None), (301, "z " * 40)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(row) for row in contract.queries()["op12_periodic_runs"](spark, str(tmp_path)).collect()]
    assert sorted(got) == sorted(plain_row(*row) for row in rows)
    whole = [tuple(row) for row in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = {row[0]: tuple(row) for row in contract.queries()["op12_periodic_runs"](spark, SMALL).collect()}
    assert len(got) == len(whole)
    short = [row for row in whole if len((row[1] or "").split()) < 1200]
    assert [got[row[0]] for row in short] == [plain_row(*row) for row in short]


# Prefix trie


def plain_trie(conversations):
    members, children, leaves, saved = defaultdict(list), defaultdict(set), {}, {}
    for conv, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv)
    for path in members:
        if path:
            children[path[:-1]].add(path)
    for path in sorted(members, key=len, reverse=True):
        leaves[path] = sum(leaves[c] for c in children[path]) or 1
        saved[path] = sum(saved[c] for c in children[path]) + ((len(members[path]) - 1) * len(path[-1][1]) if path else 0)
    rows = []
    for path, own in members.items():
        ends = ",".join(str(c) for c in sorted(own) if len(conversations[c]) == len(path))
        rows.append((min(own), len(path), min(members[path[:-1]]) if path else None, len(own), len(children[path]), leaves[path], saved[path], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(rows, key=lambda row: row[:2])


def plain_rebuilt(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, (role or "", text or "")))
    own = {conv: [turn[2] for turn in sorted(turns, key=lambda t: t[:2])] for conv, turns in own.items()}
    heads = {conv: zlib.crc32(str(conv).encode()) % 6 for conv in own}
    return {conv: own.get(conv - conv % 100, [])[: heads[conv]] + turns[heads[conv] :] for conv, turns in own.items()}


def conversation_rows():
    rng = random.Random(5)
    rows = [(c, t, rng.choice(["u", "u", None]), rng.choice(["a", "bb", None, "é漢\U0001f389"])) for c in [*range(93, 125), 200, 201, 305, 399] for t in range(rng.randint(1, 9))]
    rows += [(c, t, "u", "same") for c in (110, 111, 112, 113) for t in range(20, 31 + c % 2)]
    rows += [(400, None, "u", "first"), (400, -2, "u", "second"), (400, 7, "u", None)]
    return [*rows, (None, 1, "u", "nobody's")]


@pytest.mark.parametrize("chunk", [256, 3])
def test_nodes_equal_a_plain_trie(spark, chunk):
    rows = conversation_rows()
    table = spark.createDataFrame([(*row, 1, 2) for row in rows], "conv_id long, turn long, role string, text string, place long, n long").repartition(5)
    turns = stored(turn_trie.encoded(table), "encoded")
    got = sorted((tuple(row) for row in turn_trie.nodes(*queries.rebuilt(turns), chunk).collect()), key=lambda row: row[:2])
    assert got == plain_trie(plain_rebuilt(rows))


def test_repeated_turns_and_no_conversations(spark):
    rows = [(1, 0, "u", "a"), (1, 0, "u", "a"), (2, 0, "u", "a")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    turns = turn_trie.encoded(table)
    got = sorted((tuple(row) for row in turn_trie.nodes(turns, table.select("conv_id").distinct()).collect()), key=lambda row: row[:2])
    assert got == plain_trie({1: [("u", "a")] * 2, 2: [("u", "a")]})
    none = table.filter("false")
    assert turn_trie.nodes(turn_trie.encoded(none), none.select("conv_id")).collect() == []
    # A conversation without turns ends at the root.
    assert [tuple(row)[:4] for row in turn_trie.nodes(turn_trie.encoded(none), table.select("conv_id").distinct()).collect()] == [(1, 0, None, 2)]


def test_trie_query_equals_a_plain_trie_on_a_whole_table(spark):
    rows = [tuple(row) for row in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = sorted((tuple(row) for row in contract.queries()["op13_turn_trie"](spark, SMALL).collect()), key=lambda row: (row[1], row[0]))
    expected = sorted(plain_trie(plain_rebuilt(rows)), key=lambda row: (row[1], row[0]))
    assert got == expected


def test_medians_visit_each_place_once():
    assert list(turn_trie.medians(7)) == [3, 1, 5, 0, 2, 4, 6] and sorted(turn_trie.medians(1000)) == list(range(1000))
