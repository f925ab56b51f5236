"""Source divergence, streaming deduplication and filter audit against plain versions."""

import hashlib
import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from warcloom.llm import divergence, filter_audit, stream_dedup

SCHEMA = "doc_id long, text string, lang string, source string, rank string, value string, digest string, part string, failed string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def frame(spark, rows):
    return spark.createDataFrame([(*r, *"xxxxx") for r in rows], SCHEMA)


def some_documents(n=240, seed=3):
    rng = random.Random(seed)
    words = ["Alpha", "alpha,", "beta", "Béta", "don't", "x-ray", "X-Ray!", "naïve", "日本語", "a b", "42", "--", "Gamma.gamma", "ÉTÉ", "été"]
    rows = []
    for i in range(n):
        text = rng.choice([" ", "\n", "\t ", "\x0b"]).join(rng.choices(words, k=rng.randint(0, 40)))
        rows.append((rng.choice([i, i, i, i % 7, None]), rng.choice([text, text, text, "", None]), rng.choice(["en", "de", None, ""]), rng.choice(["s1", "s2", "s3", None])))
    rows += rows[:5]
    rows += [(9_000, "Same words here", "en", "alone"), (9_001, "long " * 30_000 + "Z" * 50_000, "en", "s1")]
    return rows


def plain_divergence(rows, min_docs, smooth, scale, top):
    docs = [((lang or ""), (source or ""), [t.translate(LOWER) for t in re.findall(divergence.TERM, text or "")]) for _, text, lang, source in rows]
    held = defaultdict(Counter)
    for lang, _, terms in docs:
        held[lang].update(set(terms))
    kept = {lang: {t for t, n in c.items() if n >= min_docs} for lang, c in held.items()}
    counts, of_lang = defaultdict(Counter), defaultdict(Counter)
    for lang, source, terms in docs:
        own = [t for t in terms if t in kept[lang]]
        counts[lang, source].update(own)
        of_lang[lang].update(own)

    def shares(count, lang):
        below = sum(count.values()) + smooth * len(kept[lang])
        return {t: 1 + scale * (count[t] + smooth) // below for t in kept[lang]}

    p = {g: shares(c, g[0]) for g, c in counts.items()}
    out = []
    for lang, source in counts:
        pairs = [(sum(abs(v - p[g][t]) for t, v in p[lang, source].items()), g[1]) for g in counts if g[0] == lang and g[1] != source]
        q = shares(of_lang[lang], lang)
        terms = [(v - q[t], t) for t, v in p[lang, source].items() if counts[lang, source][t] and v > q[t]]
        for part, items, limit in (("pair", pairs, None), ("term", terms, top)):
            ranked = sorted(items, key=lambda x: (-x[0], x[1].encode()))[:limit]
            out += [(lang, source, part, item, value, i) for i, (value, item) in enumerate(ranked, 1)]
    return sorted(out)


@pytest.mark.parametrize("block", [256, 2])
def test_divergence_equals_plain_counts(spark, monkeypatch, block):
    monkeypatch.setattr(divergence, "BLOCK", block)
    rows = some_documents()
    found = divergence.divergence(frame(spark, rows), min_docs=30, smooth=5, scale=10**9, top=6)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, found.collect())) == plain_divergence(rows, 30, 5, 10**9, 6)


def test_terms_in_doubt_are_counted_by_document(spark):
    # 20 documents have one term in two chunks each: 40 at most, 20 in truth.
    both = [(i, "word word, other", "en", "a") for i in range(20)]
    apart = [(100 + i, "term" if i % 2 else "term,", "en", "b") for i in range(40)]
    groups, kept, used = divergence.kept_counts(frame(spark, both + apart + [(1, "", "en", "c")]), 30)
    assert [tuple(r) for r in kept.collect()] == [("en", "term")]
    assert [tuple(r) for r in used.collect()] == [("en", "term", "b", 40)]
    assert sorted(r.source for r in groups.collect()) == ["a", "b", "c"]


def test_chunks_are_cut_once_and_whole(spark):
    docs = frame(spark, [(1, "a,b a,b A.a.ä " + "q,r" * 100, "en", "s"), (2, "a,b\x1fc", "en", "s"), (3, None, None, None), (4, "a,b", None, "s")])
    counts = divergence.chunk_documents(docs).collect()
    got = {r.chunk: {x.lang: x.docs for x in r.langs} for r in counts}
    assert got["a,b"] == {"en": 1, "": 1} and "" not in got and len(got) == len(counts)
    terms = divergence.chunk_terms(divergence.chunk_documents(docs)).collect()
    terms = {(r.chunk, r.lang, r.term): (r.docs, r.times) for r in terms}
    assert terms["a,b", "en", "a"] == (1, 1) and terms["A.a.ä", "en", "a"] == (1, 2) and terms["A.a.ä", "en", "ä"] == (1, 1)
    long = "q,r" * 100
    assert terms["a,b\x1fc", "en", "c"] == (1, 1)
    assert [terms[long, "en", t] for t in ("q", "rq", "r")] == [(1, 1), (1, 99), (1, 1)]


def test_chunks_move_in_buckets(spark):
    # Thousands of chunks leave a batch of text in a row for each bucket and language.
    rng = random.Random(5)
    rows = [(i, " ".join(f"w{rng.randrange(3000):x}.{rng.choice('abc')}" for _ in range(200)), "en" if i % 3 else None, rng.choice(["s 1", "s 2", None])) for i in range(120)]
    docs = frame(spark, rows).coalesce(1)
    every, none = np.full(1 << 21, 255, np.uint8), np.zeros(1 << 21, np.uint8)
    found = divergence.occurrences(docs, every, none, 4)
    assert found.count() <= 4 * 2
    counts = divergence.chunk_documents(docs)
    assert counts.count() > 3000
    used = divergence.term_counts(found, divergence.chunk_terms(counts), 4)
    plain = Counter()
    for _, text, lang, source in rows:
        plain.update((lang or "", t, source or "") for t in re.findall(divergence.TERM, text))
    assert {tuple(r)[:3]: r.n for r in used.collect()} == plain


def test_long_chunks_of_many_terms_leave_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(divergence, "BATCH_BYTES", 2_000)
    words = ["".join(p) for p in itertools.product("abcdefgh", repeat=3)]
    long = ",".join(words + words[:7])
    counts = divergence.chunk_documents(frame(spark, [(i, f"{long} x{i} É,é;É", lang, "s") for i in range(5) for lang in ("en", "de")]))
    assert [sorted(r.langs) for r in counts.filter(F.col("chunk") == long).collect()] == [[("de", 5), ("en", 5)]]
    terms = divergence.chunk_terms(counts)
    got = sorted(tuple(r)[2:] for r in terms.filter(F.col("chunk") == long).collect())
    assert got == sorted((lang, 5, w, 1 + (w in words[:7])) for w in words for lang in ("de", "en"))
    assert {(r.term, r.times) for r in terms.filter("chunk like 'É%'").collect()} == {("É", 2), ("é", 1)}


def test_divergence_of_little(spark):
    assert divergence.divergence(frame(spark, [])).collect() == []
    found = divergence.divergence(frame(spark, [(1, None, None, None), (2, "word", "", "b")]))
    assert sorted(map(tuple, found.collect())) == [("", "", "pair", "b", 0, 1), ("", "b", "pair", "", 0, 1)]


def written(path, rows, files=1):
    """Documents as Parquet files, with columns that clash with those of the result."""
    path.mkdir(exist_ok=True)
    had = len(list(path.iterdir()))
    for k in range(files):
        own = rows[k::files]
        columns = {"doc_id": pa.array([r[0] for r in own], pa.int64()), "text": pa.array([r[1] for r in own], pa.string())}
        clash = {n: pa.array(["x"] * len(own), pa.string()) for n in ("kept", "file", "row", "digest", "n", "keep_id")}
        pq.write_table(pa.table(columns | clash), path / f"part-{had + k}.parquet", row_group_size=7)
    return str(path)


def plain_dedup(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[(text or "").translate(LOWER)].append(doc_id)
    out = []
    for text, ids in groups.items():
        ids.sort(key=lambda i: (i is not None, i or 0))
        digest = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, ids[-1], len(ids), k == len(ids) - 1, digest) for k, i in enumerate(ids)]
    return sorted(out, key=str)


def dedup_rows(seed=5):
    rng = random.Random(seed)
    texts = ["", None, "Copy", "copy", "COPY", "ÄB", "äb", "one two\n", "one two", "x" * 200_000] + [f"text {i}" for i in range(25)]
    rows = [(rng.choice([i, i, 3, None, -4]), rng.choice(texts + ["Copy"] * 20)) for i in range(150)]
    return rows + rows[:3]


def answer(spark, path, **options):
    return sorted(map(tuple, stream_dedup.deduplicated(spark, path, **options).collect()), key=str)


@pytest.mark.parametrize("digest_bytes", [32, 1, 0])
def test_dedup_equals_plain_groups(spark, tmp_path, digest_bytes):
    """Cut digests collide; full bytes tell the texts apart then."""
    rows = dedup_rows()
    path = written(tmp_path / "docs", rows, files=4)
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    assert answer(spark, path, digest_bytes=digest_bytes, files_per_batch=1) == plain_dedup(rows)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before


def test_dedup_goes_on_from_its_state(spark, tmp_path):
    rows, state = dedup_rows(), str(tmp_path / "state")
    path = written(tmp_path / "docs", rows[:60], files=2)
    assert answer(spark, path, checkpoint=state) == plain_dedup(rows[:60])
    written(tmp_path / "docs", rows[60:], files=2)
    assert answer(spark, path, checkpoint=state) == plain_dedup(rows)
    assert answer(spark, path, checkpoint=state) == plain_dedup(rows)


def test_dedup_of_one_file_and_of_none(spark, tmp_path):
    path = written(tmp_path / "docs", [(1, "a"), (2, "A")])
    assert answer(spark, f"{path}/part-0.parquet") == plain_dedup([(1, "a"), (2, "A")])
    assert answer(spark, written(tmp_path / "empty", [])) == []


def failed(rows):
    out = []
    for doc_id, text, lang, _ in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        earlier = doc_id is not None and any(o[0] is not None and o[0] < doc_id and (o[1] or "") == text for o in rows)
        out.append((lang or "", [len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", text)) > 3 * len(text), bool(re.search(r"[#$%&*|]", text)), earlier]))
    return out


def plain_audit(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    out, parts = [], defaultdict(list)
    for row, (part, bits) in zip(rows, failed(rows)):
        parts[part].append((bits, row[0] in good, row[0] in toxic))
    for part, docs in parts.items():
        made, removed_by = [], Counter()
        for order in itertools.permutations(range(5)):
            left = docs
            for step, f in enumerate(order, 1):
                gone = [d for d in left if d[0][f]]
                left = [d for d in left if not d[0][f]]
                redundant = sum(d[0][f] for d in docs) - len(gone)
                unique = sum(d[0][f] and sum(d[0]) == 1 for d in docs)
                removed_by[f] += len(gone)
                made.append((f, (part, "".join("ABCDE"[i] for i in order), step, len(left), len(gone), redundant, unique, sum(d[1] for d in gone), sum(d[2] for d in gone))))
        out += [(*row, removed_by[f]) for f, row in made]
    return sorted(out)


def test_audit_equals_filters_applied_in_order(spark):
    rng = random.Random(8)
    texts = ["", "word " * 300, " ".join(f"w{i}" for i in range(300)), " ".join(f"W{i}" for i in range(250)), "A few | words", "LOUD", " ".join(f"ä{i} x" for i in range(220)) + " #", "x" * 300_000]
    rows = [(rng.choice([i, i, 4, None]), rng.choice(texts + [None]), rng.choice(["en", "fr", None]), "s") for i in range(90)]
    rows += rows[:4]
    labels = [(rng.choice([i, 4, None]), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(60)]
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert sorted(map(tuple, filter_audit.audit(frame(spark, rows), marks).collect())) == plain_audit(rows, labels)


def test_audit_without_rows(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(frame(spark, []), labels).collect() == []
    assert filter_audit.audit(frame(spark, [(1, "a", "en", "s")]), labels).count() == 600


def test_least_squares_give_the_mean_over_orders():
    rng = random.Random(1)
    for _ in range(20):
        game = [0] + [rng.randint(-50, 1_000) for _ in range(31)]
        sums = [0] * 5
        for order in itertools.permutations(range(5)):
            before = 0
            for i in order:
                sums[i] += game[before | 1 << i] - game[before]
                before |= 1 << i
        assert [v * 120 for v in filter_audit.shapley(game)] == sums
