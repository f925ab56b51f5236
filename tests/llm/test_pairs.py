"""Near-duplicates, decontamination and top-k search against brute force."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from warcloom.llm import decontaminate, near_dups, shingles, topk
from warcloom.llm.common import table

SF_DIR = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text, size):
    words = [w for w in (text or "").translate(LOWER).replace("\t", " ").replace("\n", " ").split(" ") if w]
    if not words:
        return frozenset()
    size = min(size, len(words))
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def brute_components(rows, size, percent):
    """Row by row the smallest id that can be reached."""
    sets = [shingle_set(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                common = len(sets[i] & sets[j])
                if 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                    parent[root(i)] = root(j)
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None] if sets[i] else [doc]
        out.append((doc, len(sets[i]), min(ids, default=None)))
    return out


def family(rng, base, n, edits):
    """Copies of a text, each with some words replaced, some of those shared by several."""
    words, shared, out = base.split(), [f"new{k}" for k in range(4)], []
    for _ in range(n):
        own = list(words)
        for _ in range(rng.randint(0, edits)):
            k = rng.randrange(len(own))
            choice = rng.random()
            if choice < 0.4:
                own[k] = f"w{rng.randrange(10**6)}"
            elif choice < 0.7:
                own[k] = rng.choice(shared)
            elif choice < 0.85:
                del own[k]
            else:
                own.insert(k, rng.choice(words))
        out.append(" ".join(own))
    return out


@pytest.mark.parametrize("size, percent, seed", [(2, 80, 1), (2, 80, 2), (5, 80, 3)])
def test_components(text_rows, size, percent, seed):
    rng = random.Random(seed)
    texts = [None, "", " \t\n", "one", "One", "two words", "a b c", "x " * 5_000, "a b  c\n"]
    for length, n, edits in ((40, 60, 9), (120, 60, 25), (300, 30, 50)):
        base = " ".join(f"t{rng.randrange(60)}" for _ in range(length))
        texts += family(rng, base, n, edits)
    rows = [(k * 7919 % 1009, t) for k, t in enumerate(texts)] + [(None, texts[20]), (None, "only here"), (rng.randrange(1009), texts[30])]
    got = near_dups.near_duplicates(text_rows(rows), size, percent).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == Counter(brute_components(rows, size, percent))
    assert all(r.kept == (r.doc_id is not None and r.doc_id == r.component_id) for r in got)


def test_stars_need_their_second_step(text_rows):
    """Members that are similar to one another, but not to the centre, are found."""
    rng = random.Random(9)
    base = [f"b{k}" for k in range(60)]
    texts = [" ".join(base)] * 1 + [" ".join(w if rng.random() > 0.04 else f"r{rng.randrange(10**6)}" for w in base) for _ in range(60)]
    far = [w if k % 9 else f"far{k}" for k, w in enumerate(base)]
    texts += [" ".join(far), " ".join(far[:-1] + ["end"]), " ".join(far[1:])]
    rows = list(enumerate(texts))
    got = near_dups.near_duplicates(text_rows(rows), 2, 80).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted(brute_components(rows, 2, 80))


def test_prefixes_lose_no_pair():
    """Similar members of a star of which one is unlinked share a feature of their prefixes."""
    rng = np.random.default_rng(3)
    checked = 0
    for _ in range(3_000):
        center = np.unique(rng.integers(0, 2**60, rng.integers(5, 60), dtype=np.uint64))

        def changed(s, share):
            kept = s[rng.random(len(s)) > share]
            return np.unique(np.concatenate([kept, rng.integers(0, 2**60, int(share * len(s) * rng.random() * 2), dtype=np.uint64)]))

        u = changed(center, 0.3 * rng.random())
        w = changed(u, 0.15 * rng.random())
        if not len(u) or not len(w):
            continue
        common = shingles.held(u, w).sum()
        a, b = near_dups.difference(center, u, 80), near_dups.difference(center, w, 80)
        for x, (more, lacks, linked, features) in ((u, a), (w, b)):
            same = shingles.held(x, center).sum()
            assert linked == (100 * same >= 80 * (len(x) + len(center) - same)) and len(features) == more + lacks
        if 100 * common >= 80 * (len(u) + len(w) - common) and not (a[2] and b[2]):
            checked += 1
            left, right = (a, b) if not a[2] else (b, a)
            for salt in rng.integers(0, 2**60, 3):
                order = lambda row: sorted(row[3].tolist(), key=lambda f: f ^ int(salt))
                cut = lambda row: near_dups.prefixes(100 * row[1] + 80 * row[0], len(center), len(row[3]), 80)
                assert set(order(left)[: max(0, cut(left)[1])]) & set(order(right)[: max(0, cut(right)[0])])
    assert checked > 200


def test_signatures_meet_as_often_as_sets_agree():
    rng = np.random.default_rng(1)
    bands = shingles.Bands(40, 5)
    met = 0
    for _ in range(300):
        common = rng.integers(0, 2**63, 80, dtype=np.uint64)
        a, b = (np.unique(np.concatenate([common, rng.integers(0, 2**63, 10, dtype=np.uint64)])) for _ in range(2))
        met += bool((bands.keys(a) == bands.keys(b)).any())
    assert met == 300 and near_dups.chance_to_meet(0.8) > 1 - 1e-6


@pytest.mark.parametrize("n", [5, 6, 10])
def test_small_sets_meet(n):
    """Sets of a few shingles, where nearly all bins are empty, that differ in one of them."""
    rng = np.random.default_rng(n)
    bands = shingles.Bands(40, 5)
    with np.errstate(over="ignore"):
        for _ in range(4_000):
            a = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
            assert (bands.keys(a) == bands.keys(np.delete(a, rng.integers(n)))).any()


def test_one_of_each(text_rows):
    long = " ".join(f"w{k}" for k in range(200))
    rows = [(5, long), (5, long), (9, long + " more"), (None, long), (None, "no id at all"), (None, "no id at all"), (1, None), (2, ""), (5, "other text")]
    left = near_dups.one_of_each(text_rows(rows))
    assert left.columns == text_rows(rows).columns
    got = sorted(((r.doc_id, r.text) for r in left.collect()), key=str)
    assert got == sorted([(5, long), (None, "no id at all"), (1, None), (2, ""), (5, "other text")], key=str)


def test_one_of_each_of_a_repeated_id(text_rows):
    """Similar texts of one id are one component, of which one row stays; others of the id stay too."""
    long = " ".join(f"w{k}" for k in range(200))
    copies = [(5, long), (5, long + " more"), (5, "first " + long), (None, long + " end"), (8, long)]
    other = " ".join(f"o{k}" for k in range(50))
    rows = [*copies, (5, other), (5, other + " more"), (5, "a third text of the id"), (5, ""), (5, None)]
    got = [(r.doc_id, r.text) for r in near_dups.one_of_each(text_rows(rows)).collect()]
    of_long = [r for r in got if r in copies]
    of_other = [r for r in got if (r[1] or "").startswith(other)]
    assert len(of_long) == len(of_other) == 1 and of_long[0][0] == of_other[0][0] == 5
    rest = [r for r in got if r not in of_long + of_other]
    assert sorted(rest, key=str) == sorted([(5, "a third text of the id"), (5, ""), (5, None)], key=str)


def test_near_duplicates_of_nothing(text_rows):
    assert near_dups.near_duplicates(text_rows([])).count() == 0
    assert near_dups.one_of_each(text_rows([])).count() == 0


def brute_overlaps(docs, items):
    found = {}
    for doc, text in docs:
        words = np.array(decontaminate.WORDS.findall((text or "").lower()), dtype=object)
        for item, own in items:
            a = np.array(decontaminate.WORDS.findall((own or "").lower()), dtype=object)
            if item is None or len(a) < decontaminate.SHORTEST:
                continue
            for offset in range(-len(a) + 1, len(words)):
                place = decontaminate.overlap(a, words, offset, 80)
                if place:
                    best = (-place[2], place[0], place[1])
                    found[doc, item] = min(found.get((doc, item), best), best)
    return {(d, i, b[1], b[2], -b[0]) for (d, i), b in found.items()}


def test_overlaps(spark, text_rows):
    rng = random.Random(4)
    items = [(k, " ".join(f"v{rng.randrange(40)}" for _ in range(n))) for k, n in enumerate((3, 5, 7, 10, 12, 13, 20, 59))]
    items += [(100, None), (101, ""), (None, "a b c d e f g h"), (7, items[6][1])]
    docs = [(0, None), (1, ""), (2, "short"), (None, items[6][1]), (None, items[7][1])]
    for k in range(60):
        item = rng.choice(items[:8])[1].split()
        item = [w if rng.random() > 0.2 else "other" for w in item]
        low = rng.randrange(3)
        docs.append((10 + k, " ".join([f"v{rng.randrange(40)}" for _ in range(rng.randrange(30))] + item[low:] + ["the", "End."])))
    docs += [(10, docs[-1][1]), (5, "filler " * 20_000 + items[7][1].upper() + " filler" * 100)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.overlaps(text_rows(docs), bench).collect()
    assert {tuple(r) for r in got} == brute_overlaps(docs, items) and len(got) == len({(r.doc_id, r.item_id) for r in got})
    bad = {r.doc_id for r in got}
    left = decontaminate.clean(text_rows(docs), bench).collect()
    assert sorted(map(str, (r.doc_id for r in left))) == sorted(str(d) for d, _ in docs if d not in bad)


def test_clean_decides_by_text(spark, text_rows):
    """One contaminated row takes no clean row of its id, or without an id, with it."""
    item = " ".join(f"v{k}" for k in range(20))
    rows = [(None, "before " + item), (None, "a clean text"), (None, None), (5, item + " after"), (5, "another clean one"), (5, ""), (6, item)]
    docs, bench = text_rows(rows), spark.createDataFrame([(1, item)], "item_id long, text string")
    left = decontaminate.clean(docs, bench, together=False)
    assert left.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in left.collect()), key=str)
    assert got == sorted([(None, "a clean text"), (None, None), (5, "another clean one"), (5, "")], key=str)
    # Where rows of an id are asked to go together, those without an id still don't.
    got = sorted(((r.doc_id, r.text) for r in decontaminate.clean(docs, bench).collect()), key=str)
    assert got == sorted([(None, "a clean text"), (None, None)], key=str)


def test_a_seed_is_mixed_once(monkeypatch):
    """However many places a mask has; the masked-out ones alone don't enter."""
    calls, real = [], decontaminate.mixed
    monkeypatch.setattr(decontaminate, "mixed", lambda x: calls.append(1) or real(x))
    words = np.arange(100, 140, dtype=np.uint64) * decontaminate.ODD
    for mask in decontaminate.MASKS + decontaminate.SHORT_MASKS:
        calls.clear()
        found = decontaminate.seeds(words, mask)
        assert len(calls) == 1 and len(set(found.tolist())) == len(found) == 41 - len(mask)
        for k, used in enumerate(mask):
            other = words.copy()
            other[5 + k] += np.uint64(1)
            assert (decontaminate.seeds(other, mask)[5] == found[5]) == (used == "0")


def test_words_of_two_documents_are_no_overlap(spark):
    words = [f"word{i}" for i in range(26)]
    for cut in (6, 13, 20):
        docs = [(1, " ".join(words[:cut])), (2, ""), (3, " ".join(words[cut:])), (4, "a b " + " ".join(words[3:16]))]
        docs = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
        items = spark.createDataFrame([(7, " ".join(words[cut - 6 : cut + 6] + ["z"]))], "item_id long, text string")
        assert {r.doc_id for r in decontaminate.overlaps(docs, items, 100).collect()} == set()


def test_overlaps_of_nothing(spark, text_rows):
    bench = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.overlaps(text_rows([]), bench).count() == 0
    assert decontaminate.overlaps(text_rows([(1, "a b c d e f")]), none).count() == 0
    assert decontaminate.clean(text_rows([(1, "a b c d e f"), (2, "x")]), none).count() == 2


def brute_top_k(rows, k):
    out = []
    for q, a in {(q, tuple(a)) for q, a in rows if q % 20 == 0}:
        scores = sorted((-int(np.dot(a, b)), v) for v, b in rows if v != q and len(a) == len(b))
        out += [(q, n + 1, v, -s) for n, (s, v) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("n, d, block", [(300, 64, 64), (90, 3, 16), (10, 1, 4)])
def test_top_k(spark, n, d, block):
    rng = np.random.default_rng(n)
    rows = [(v, np.floor(64 * rng.normal(0, 0.2, d)).astype(int).tolist()) for v in range(n)]
    rows += [(n + 20 + k, list(rows[k % 5][1])) for k in range(40)]
    frame = spark.createDataFrame(rows + rows[:7], "vec_id long, ints array<long>")
    got = topk.top_k(frame, frame.filter("vec_id % 20 = 0"), 20, queries_per_block=4, rows_per_block=block)
    assert sorted(tuple(r) for r in got.collect()) == brute_top_k(rows + rows[:7], 20)


def test_repeated_rows_are_candidates_each(spark):
    frame = spark.createDataFrame([(20, [1, 1])] * 2 + [(1, [2, 2])] * 3 + [(2, [1, 0])], "vec_id long, ints array<long>")
    got = topk.top_k(frame, frame.filter("vec_id = 20"), 3).collect()
    assert sorted(tuple(r) for r in got) == [(20, 1, 1, 4), (20, 2, 1, 4), (20, 3, 1, 4)]
    assert topk.top_k(frame, frame.filter("vec_id = 20"), 20).count() == 4


def test_top_k_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, -0.25]), (20, None), (40, [1.0, None]), (60, [nan, 1.0]), (1, [inf, 0.0]), (2, [0.1, 0.1]), (None, [1.0, 1.0]), (3, [1.0]), (80, []), (100, [-1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").filter(topk.usable("embedding"))
    ints = frame.select("vec_id", topk.scaled("embedding", 64).alias("ints"))
    got = topk.top_k(ints, ints.filter("vec_id % 20 = 0"), 20).collect()
    assert {tuple(r) for r in got} == {(0, 1, 2, 6 * 32 - 6 * 16), (100, 1, 3, -64 * 64)}
    assert topk.top_k(ints.limit(0), ints.limit(0), 20).count() == 0


def test_bounds_hold():
    rng = np.random.default_rng(2)
    q, v = rng.normal(0, 30, (50, 64)), rng.normal(0, 30, (80, 64))
    exact, before = q @ v.T, np.inf
    for segments in topk.RESOLUTIONS:
        bound = topk.statistics(q, segments) @ topk.statistics(v, segments).T
        assert (bound >= exact - 1e-6).all() and (bound <= before + 1e-6).all()
        before = bound


def test_whole_documents_table(spark):
    docs = table(spark, SF_DIR, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = near_dups.near_duplicates(docs, 2, 80).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted(brute_components(rows, 2, 80))
    bench = table(spark, SF_DIR, "benchmark")
    found = decontaminate.overlaps(docs, bench).filter(F.col("n_words") >= 5).collect()
    items = [(r.item_id, r.text) for r in bench.collect()]
    held = {(d, i) for d, t in rows for i, x in items if x and x in (t or "")}
    assert held <= {(r.doc_id, r.item_id) for r in found}


def test_columns_named_like_results(spark):
    """What comes in under the names of results is neither read nor carried."""
    rows = [(1, "a b c d e f", "x", "y", 9), (2, "a b c d e f", "x", "y", 9), (3, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string, kept string, n_shingles int")
    got = {r.doc_id: (r.component_id, r.kept, r.n_shingles) for r in near_dups.near_duplicates(docs, 2, 80).collect()}
    assert got == {1: (1, True, 5), 2: (1, False, 5), 3: (3, True, 0)}
    frame = spark.createDataFrame([(20, [1, 2], 7, 0.5), (1, [3, 4], 8, 0.6)], "vec_id long, ints array<long>, rank int, score double")
    assert [tuple(r) for r in topk.top_k(frame, frame.filter("vec_id = 20"), 5).collect()] == [(20, 1, 1, 11)]


def test_tiny_items_and_long_ones(spark):
    """Items of few words overlap texts that consist of them; a long item doesn't widen other hits."""
    long_item = " ".join(f"w{i}" for i in range(3_000))
    items = spark.createDataFrame([(1, "Yes."), (2, "the quick fox"), (3, long_item), (4, "one two three four five six")], "item_id long, text string")
    docs = [
        (1, "yes"), (2, "Yes! He said yes."), (3, "THE QUICK, FOX"), (4, "the quick fox runs"), (5, "x " * 500 + long_item + " y" * 500),
        (6, "x " * 500 + "one two three four five six" + " y" * 500), (7, ""), (8, None), (9, " ".join(f"w{i}" for i in range(1_000, 1_020))),
    ]
    got = decontaminate.overlaps(spark.createDataFrame(docs, "doc_id long, text string"), items).collect()
    assert {(r.doc_id, r.item_id): (r.first_word, r.n_words, r.n_agree) for r in got} == {
        (1, 1): (0, 1, 1), (3, 2): (0, 3, 3), (5, 3): (500, 3_000, 3_000), (6, 4): (500, 6, 6), (9, 3): (0, 20, 20)
    }
