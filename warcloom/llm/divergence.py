"""Source divergence audit: how the sources of a language differ in the terms they use.

Terms are runs of ASCII letters and of characters beyond ASCII, A to Z lowered. None
crosses ASCII white space, so texts are factored into *chunks* between white space:

1. The distinct chunks of each document are counted: in how many documents of a language a
   chunk is. Sums are formed before anything moves. Chunks move packed, a row for those of a
   language and bucket in some MB of text; their number of buckets follows the input.
2. Each distinct chunk is cut into terms once, however often and wherever it occurs, and
   its terms are joined back to the counts.
3. A language keeps the terms that stand in ``min_docs`` of its documents. A term's
   documents are at least those of its commonest chunk, and at most the sum over its
   chunks: most terms are decided by that. Chunks of terms below it are of no more use.
   Documents are read again for the other chunks, told by a bit table of fixed size.
   Occurrences are counted by language, source and chunk, and joined with the chunk's
   terms bucket by bucket. Where the bound lies in between (chunks such as ``word`` and
   ``word,`` may share documents), the distinct documents of a term are counted as well.
4. A source's share of a term is p = 1 + floor(scale * (count + smooth) / (N + smooth * V)),
   in whole numbers throughout, N being the sum of counts over the V kept terms.
5. ``pair`` rows sum abs(p - q) over the kept terms for two sources. Shares are laid out by
   term; a task takes some terms and two blocks of at most ``BLOCK`` sources, and gives one
   partial sum for each pair of sources, so no pair is formed term by term. Terms that
   neither source has add the same number each, and are only counted.
6. ``term`` rows are the terms that a source uses more than its language does, by p - q.

Null text, language and source are empty strings. A language without kept terms (as in an
empty or a small table) gives pairs with the value 0 and no ``term`` row; a source alone in
its language gives no pair. Rows count one by one, whether ids repeat, are null or not; ids
aren't read. Texts of any length are counted whole. Columns beyond those named are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from warcloom.llm.common import chunks, drop_stage, row_type, settings, stage_path, staged, tidied
from warcloom.llm.decontaminate import bit_table, bits_of

#: Fixed value: what a term is.
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
#: ASCII characters that are in no term, and UTF-8 bytes with a space for each of these, letters lowered.
AROUND = "".join(chr(c) for c in range(1, 128) if not re.match(TERM, chr(c)))
LETTERS = bytes(ord(chr(c).lower()) if re.match(TERM, chr(c)) else 32 for c in range(128)) + bytes(range(128, 256))
#: Bytes of text that are cut at a time.
BATCH_BYTES = 8 << 20
#: Buckets of chunks, and the least number of them.
BUCKETS_PER_TASK = 8
LEAST_BUCKETS = 64
#: That of Spark's function of the same name.
SEED = 42
#: Sources and shares that meet in one task.
BLOCK = 256
SLICE = 5_000
SLICES = 16
#: Terms that a task lays out at a time.
STRIP = 2_048


def _source(docs: DataFrame) -> DataFrame:
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return docs.select(text("lang").alias("lang"), text("source").alias("source"), text("text").alias("text"))


def _cut(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(row, distinct chunks, place among them) of all chunks of some texts."""
    lists = pc.ascii_split_whitespace(texts)
    every = lists.flatten().dictionary_encode()
    row = np.repeat(np.arange(len(texts)), lists.value_lengths().to_numpy())
    distinct, index = every.dictionary, every.indices.to_numpy().astype(np.int64)
    # White space at the ends leaves empty strings.
    if (empty := distinct.index("").as_py()) >= 0:
        row, index = row[index != empty], index[index != empty]
    return row, distinct, index


def _keys(distinct: pa.Array) -> np.ndarray:
    """A hash of each chunk. Chunks that differ by case and by what stands around letters share it."""
    from pandas.util import hash_array

    bare = pc.ascii_lower(pc.ascii_trim(distinct, characters=AROUND)).to_numpy(zero_copy_only=False)
    return hash_array(bare, categorize=False).view(np.int64)


def _starts(ordered: np.ndarray) -> np.ndarray:
    """Where values begin in a sorted array."""
    return np.flatnonzero(np.concatenate([[len(ordered) > 0], ordered[1:] != ordered[:-1]])[: len(ordered)])


def _summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sums of their values."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = _starts(keys)
    return keys[starts], np.add.reduceat(values[order], starts) if len(starts) else values[:0]


def _lists(starts: np.ndarray, size: int) -> pa.Array:
    return pa.array(np.append(starts, size).astype(np.int32))


def _joined(starts: np.ndarray, strings: pa.Array) -> pa.Array:
    """Chunks between starts as one string; chunks have no white space."""
    return pc.binary_join(pa.ListArray.from_arrays(_lists(starts, len(strings)), strings), " ")


def _bytes(starts: np.ndarray, values: np.ndarray) -> pa.Array:
    """Whole numbers between starts as the bytes of 32-bit ones: those of a batch fit."""
    ends = np.append(starts, len(values)).astype(np.int32) * 4
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(values.astype("<i4").tobytes())])


def _numbers(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i4").astype(np.int64)


def _flat(lists: pa.ListArray) -> tuple[pa.Array, np.ndarray]:
    """(all values, how many each list has)"""
    return lists.flatten(), lists.value_lengths().to_numpy()


def _split(column: pa.ChunkedArray) -> tuple[pa.Array, np.ndarray]:
    return _flat(pc.split_pattern(pa.concat_arrays(column.chunks), " "))


def _bucket_number(docs: DataFrame) -> int:
    """Buckets follow the tasks that read the documents, so that one is always small."""
    return max(LEAST_BUCKETS, BUCKETS_PER_TASK * docs.select("lang").rdd.getNumPartitions())


def chunk_documents(docs: DataFrame) -> DataFrame:
    """``chunk``, ``key``, ``langs`` (``lang``, ``docs``): in how many documents of each language a chunk is.

    A row a chunk; it lists languages, not documents. Chunks move in buckets of their hashes
    ``key``, a row for all those of a language in some MB of text.
    """
    buckets = _bucket_number(docs)
    packed = row_type(bucket="integer", lang="string", chunks="string", docs="binary")
    of_lang = row_type(lang="string", docs="long")
    schema = row_type(chunk="string", key="long", langs=T.ArrayType(of_lang))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text", limit=BATCH_BYTES):
            row, distinct, index = _cut(batch.column(2))
            size = max(1, len(distinct))
            langs = batch.column(0).dictionary_encode()
            # Sorted, each chunk of a document once.
            pairs = np.sort(row * size + index)
            pairs = pairs[_starts(pairs)]
            held, docs = np.unique(langs.indices.to_numpy()[pairs // size] * size + pairs % size, return_counts=True)
            places = held // size * buckets + (np.mod(_keys(distinct), buckets))[held % size]
            order = np.argsort(places, kind="stable")
            places, held, docs = places[order], held[order], docs[order]
            starts = _starts(places)
            columns = [
                pa.array((places[starts] % buckets).astype(np.int32)),
                langs.dictionary.take(pa.array(places[starts] // buckets)),
                _joined(starts, distinct.take(pa.array(held % size))),
                _bytes(starts, docs),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=packed.names)

    def merge(table: pa.Table) -> pa.Table:
        every, sizes = _split(table["chunks"])
        every, langs = every.dictionary_encode(), pa.concat_arrays(table["lang"].chunks).dictionary_encode()
        lang = np.repeat(langs.indices.to_numpy(), sizes)
        n = len(langs.dictionary)
        held, docs = _summed(every.indices.to_numpy().astype(np.int64) * n + lang, _numbers(table["docs"]))
        entries = pa.StructArray.from_arrays([langs.dictionary.take(pa.array(held % n)), pa.array(docs)], names=of_lang.names)
        lists = pa.ListArray.from_arrays(_lists(_starts(held // n), len(held)), entries)
        return pa.Table.from_arrays([every.dictionary, pa.array(_keys(every.dictionary)), lists], names=schema.names)

    return _source(docs).mapInArrow(tidied(run), packed).groupBy("bucket").applyInArrow(merge, schema)


def _terms(some: pa.Array) -> pa.ListArray:
    """The terms of chunks, with empty strings between them."""
    offsets = np.frombuffer(some.buffers()[1], np.int32)[some.offset : some.offset + len(some) + 1]
    data = some.buffers()[2].slice(offsets[0], offsets[-1] - offsets[0]).to_pybytes() if len(some) and offsets[-1] > offsets[0] else b""
    spaced = pa.StringArray.from_buffers(len(some), pa.py_buffer((offsets - offsets[0]).tobytes()), pa.py_buffer(data.translate(LETTERS)))
    return pc.ascii_split_whitespace(spaced)


def chunk_terms(counts: DataFrame) -> DataFrame:
    """``chunk``, ``key``, ``lang``, ``docs``, ``term``, ``times``: each chunk cut once, joined with its counts."""
    schema = row_type(chunk="string", key="long", lang="string", docs="long", term="string", times="long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "chunk", limit=BATCH_BYTES):
            terms, sizes = _flat(_terms(batch.column(0)))
            terms = terms.dictionary_encode()
            size = max(1, len(terms.dictionary))
            pairs, times = np.unique(np.repeat(np.arange(batch.num_rows), sizes) * size + terms.indices.to_numpy(), return_counts=True)
            if (empty := terms.dictionary.index("").as_py()) >= 0:
                pairs, times = pairs[pairs % size != empty], times[pairs % size != empty]
            langs, n_langs = _flat(batch.column(2))
            row = pairs // size
            many = n_langs[row]
            ends, first = np.cumsum(many), (np.cumsum(n_langs) - n_langs)[row]
            # Some rows at a time: each repeats its chunk, which may be long and of many terms.
            weight = np.cumsum(many * (pc.binary_length(batch.column(0)).to_numpy()[row] + 64))
            low = 0
            while low < len(pairs):
                high = max(low + 1, int(np.searchsorted(weight, (weight[low - 1] if low else 0) + BATCH_BYTES, side="right")))
                pair = np.repeat(np.arange(low, high), many[low:high])
                entry = langs.take(pa.array(first[pair] + np.arange(len(pair)) + (ends[low] - many[low]) - (ends - many)[pair]))
                columns = [*(batch.column(i).take(pa.array(row[pair])) for i in (0, 1)), entry.field("lang"), entry.field("docs")]
                columns += [terms.dictionary.take(pa.array(pairs[pair] % size)), pa.array(times[pair])]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)
                low = high

    return counts.select("chunk", "key", "langs").mapInArrow(run, schema)


def occurrences(docs: DataFrame, wanted: np.ndarray, doubtful: np.ndarray, buckets: int) -> DataFrame:
    """What documents have of chosen chunks.

    Bit tables choose them, so there are some others among them. Rows without ``doc`` count
    occurrences, those of a ``bucket`` and ``lang`` in some MB of text at a time: ``chunks``,
    in how many ``sources`` each is (``sizes``), and for each of these its place in
    ``sources`` and the count (``places``, ``counts``). Rows with ``doc``, a number that the
    documents get here, are of doubtful chunks, once a document.
    """
    schema = row_type(lang="string", bucket="integer", chunks="string", sizes="binary", sources=T.ArrayType(T.StringType()), places="binary", counts="binary", doc="long")
    shared = docs.sparkSession.sparkContext.broadcast((wanted.tobytes(), doubtful.tobytes()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        tables = [np.unpackbits(np.frombuffer(t, np.uint8)).astype(bool) for t in shared.value]
        number = TaskContext.get().partitionId() << 36

        def made(size: int, **columns: pa.Array) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(size, f.type)) for f in arrow], schema=arrow)

        for batch in chunks(batches, "text", limit=BATCH_BYTES):
            row, distinct, index = _cut(batch.column(2))
            size = max(1, len(distinct))
            langs, names = batch.column(0).dictionary_encode(), batch.column(1).dictionary_encode()
            n_sources = max(1, len(names.dictionary))
            group = langs.indices.to_numpy().astype(np.int64) * n_sources + names.indices.to_numpy()
            keys = _keys(distinct)
            of_lang = np.array([xxhash.xxh64_intdigest(v.encode(), SEED) for v in langs.dictionary.to_pylist()], np.uint64).view(np.int64)

            def inside(table: np.ndarray, chunk: np.ndarray, lang: np.ndarray) -> np.ndarray:
                first, second = bits_of((keys[chunk] ^ of_lang[lang]).view(np.uint64))
                return table[first] & table[second]

            # Occurrences of chosen chunks, summed by language, source and chunk.
            held, n = np.unique(group[row] * size + index, return_counts=True)
            chunk, lang = held % size, held // size // n_sources
            own = inside(tables[0], chunk, lang)
            doubted = np.zeros(size, dtype=bool)
            doubted[chunk[own][inside(tables[1], chunk[own], lang[own])]] = True
            held, n, chunk, lang = held[own], n[own], chunk[own], lang[own]
            bucket = np.mod(keys, buckets)[chunk]
            order = np.lexsort((chunk, lang * buckets + bucket))
            held, n, chunk, lang, bucket = held[order], n[order], chunk[order], lang[order], bucket[order]
            rows = lang * buckets + bucket
            starts = _starts(rows)
            # The chunks of a row, and where each one's sources begin.
            heads = _starts(rows * size + chunk)
            sizes = np.diff(np.append(heads, len(chunk)))
            of_row = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(rows))))
            used, place = np.unique(of_row * n_sources + held // size % n_sources, return_inverse=True)
            first = _starts(used // n_sources)
            yield made(
                len(starts),
                lang=langs.dictionary.take(pa.array(lang[starts])),
                bucket=pa.array(bucket[starts].astype(np.int32)),
                chunks=_joined(np.searchsorted(heads, starts), distinct.take(pa.array(chunk[heads]))),
                sizes=_bytes(np.searchsorted(heads, starts), sizes),
                sources=pa.ListArray.from_arrays(_lists(first, len(used)), names.dictionary.take(pa.array(used % n_sources))),
                places=_bytes(starts, place - first[of_row]),
                counts=_bytes(starts, n),
            )
            own = doubted[index]
            row, index = row[own], index[own]
            own = inside(tables[1], index, langs.indices.to_numpy()[row])
            pairs = np.sort(row[own] * size + index[own])
            pairs = pairs[_starts(pairs)]
            doc = pairs // size
            yield made(len(pairs), lang=langs.dictionary.take(langs.indices.take(pa.array(doc))), chunks=distinct.take(pa.array(pairs % size)), doc=pa.array(number + doc))
            number += batch.num_rows

    return _source(docs).mapInArrow(tidied(run), schema)


def term_counts(found: DataFrame, likely: DataFrame, buckets: int) -> DataFrame:
    """``lang``, ``term``, ``source``, ``n``: the counts that ``occurrences`` gives, joined with the chunks' terms.

    A task joins a bucket, and most of a term's chunks share one.
    """
    schema = row_type(lang="string", source="string", term="string", n="long")

    def run(counts: pa.Table, terms: pa.Table) -> pa.Table:
        if counts.num_rows == 0 or terms.num_rows == 0:
            return pa.Table.from_arrays([pa.array([], pa.string())] * 3 + [pa.array([], pa.int64())], names=schema.names)
        whole = lambda table, name: pa.concat_arrays(table[name].chunks)
        chunk, sizes = _split(counts["chunks"])
        all_chunks = pa.concat_arrays([whole(terms, "chunk"), chunk]).dictionary_encode()
        all_langs = pa.concat_arrays([whole(terms, "lang"), whole(counts, "lang")]).dictionary_encode()
        cut, n_langs = terms.num_rows, len(all_langs.dictionary)
        of_lang, of_chunk = all_langs.indices.to_numpy().astype(np.int64), all_chunks.indices.to_numpy().astype(np.int64)
        # The terms of each chunk lie side by side.
        keys = of_chunk[:cut] * n_langs + of_lang[:cut]
        order = np.argsort(keys, kind="stable")
        keys, term, times = keys[order], whole(terms, "term").dictionary_encode(), whole(terms, "times").to_numpy()[order]
        term_of = term.indices.to_numpy().astype(np.int64)[order]
        row = np.repeat(np.arange(counts.num_rows), sizes)
        lang = of_lang[cut:][row]
        own = of_chunk[cut:] * n_langs + lang
        low, high = np.searchsorted(keys, own), np.searchsorted(keys, own, side="right")
        # Each count, once for each term of its chunk.
        sources, n_sources = _flat(whole(counts, "sources"))
        sources = sources.dictionary_encode()
        at = np.repeat(np.arange(len(own)), _numbers(counts["sizes"]))
        place = (np.cumsum(n_sources) - n_sources)[row[at]] + _numbers(counts["places"])
        source, n = sources.indices.to_numpy().astype(np.int64)[place], _numbers(counts["counts"])
        many = (high - low)[at]
        entry = np.repeat(np.arange(len(at)), many)
        which = low[at][entry] + np.arange(len(entry)) - (np.cumsum(many) - many)[entry]
        size, among = max(1, len(sources.dictionary)), max(1, len(term.dictionary))
        keys, n = _summed((lang[at][entry] * among + term_of[which]) * size + source[entry], n[entry] * times[which])
        columns = [all_langs.dictionary.take(pa.array(keys // size // among)), sources.dictionary.take(pa.array(keys % size)), term.dictionary.take(pa.array(keys // size % among)), pa.array(n)]
        return pa.Table.from_arrays(columns, names=schema.names)

    terms = likely.select(F.pmod("key", F.lit(buckets)).cast("int").alias("bucket"), "chunk", "lang", "term", "times")
    rows = found.select("bucket", "lang", "chunks", "sizes", "sources", "places", "counts")
    joined = rows.groupBy("bucket").cogroup(terms.groupBy("bucket")).applyInArrow(run, schema)
    return joined.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"))


def kept_counts(docs: DataFrame, min_docs: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(groups, kept, used): all ``lang``, ``source``; the ``lang``, ``term`` that stand in
    ``min_docs`` documents of the language; and ``lang``, ``source``, ``term``, ``n``, their
    occurrences.
    """
    joined = staged(chunk_terms(chunk_documents(docs)), "chunks")
    bounds = joined.groupBy("lang", "term").agg(F.max("docs").alias("low"), F.sum("docs").alias("high"))
    bounds = staged(bounds.filter(F.col("high") >= min_docs), "bounds")
    sure = F.col("low") >= min_docs
    likely = staged(joined.join(bounds.select("lang", "term", sure.alias("sure")), ["lang", "term"]).drop("docs"), "likely")

    # A chunk is looked for in the languages where it matters.
    seed = F.col("key").bitwiseXOR(F.xxhash64("lang"))
    chosen = likely.select(seed.alias("seed"))
    doubtful = likely.filter("NOT sure").select(seed.alias("seed"))
    # Written at once: the numbers of documents hold from here on. The two kinds of rows lie apart.
    path = stage_path(docs.sparkSession, "occurrences")
    buckets = _bucket_number(docs)
    made = occurrences(docs, bit_table(chosen), bit_table(doubtful), buckets).withColumn("counted", F.col("doc").isNull())
    with settings(docs.sparkSession, {"spark.sql.maxConcurrentOutputFileWriters": "2"}):
        made.write.option("compression", "zstd").partitionBy("counted").parquet(path)
    found = docs.sparkSession.read.schema(made.schema).parquet(path)
    of_doc = found.filter("NOT counted").select("lang", F.col("chunks").alias("chunk"), "doc")
    exact = of_doc.join(likely.filter("NOT sure"), ["lang", "chunk"]).select("lang", "term", "doc").distinct()
    exact = exact.groupBy("lang", "term").agg(F.count("*").alias("docs")).filter(F.col("docs") >= min_docs)
    kept = staged(bounds.filter(sure).select("lang", "term").union(exact.select("lang", "term")), "kept")

    groups = _source(docs).select("lang", "source").distinct()
    terms = likely.join(kept, ["lang", "term"], "left_semi")
    used = staged(term_counts(found.filter("counted"), terms, buckets), "used")
    drop_stage(docs.sparkSession, path)
    return groups, kept, used


def share(count: Column, total: Column, terms: Column, scale: int, smooth: int) -> Column:
    """p, in whole numbers: products don't fit 64 bits, so decimals of 38 digits divide."""
    whole = lambda c: c.cast("decimal(18,0)")
    above = (whole(count) + F.lit(smooth)).cast("decimal(20,0)") * F.lit(scale).cast("decimal(12,0)")
    below = (whole(total) + F.lit(smooth) * whole(terms)).cast("decimal(20,0)")
    return F.call_function("div", above, below) + F.lit(1)


def pair_sums(cells: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang``, ``source``, ``item``, ``value``: abs(p - q) summed over all kept terms, for all pairs.

    ``cells`` has ``lang``, ``source``, ``term`` and ``p`` where a source has the term,
    ``groups`` has ``lang``, ``source``, ``base`` (p of a term that a source lacks) and
    ``terms`` (how many are kept).
    """
    of_lang = Window.partitionBy("lang")
    number = F.row_number().over(of_lang.orderBy("source")) - 1
    numbered = staged(groups.withColumn("no", number).withColumn("sources", F.count("*").over(of_lang)), "numbered")
    sizes = cells.groupBy("lang").agg(F.count("*").alias("cells"))
    blocks = F.ceil(F.col("sources") / BLOCK).cast("int")
    slices = F.greatest(F.lit(SLICES), F.ceil(F.coalesce("cells", F.lit(0)) / SLICE)).cast("int")
    placed = numbered.join(sizes, "lang", "left").select(
        "lang", "source", "no", "base", blocks.alias("blocks"), slices.alias("slices"), F.floor(F.col("no") / BLOCK).cast("int").alias("block")
    )
    placed = staged(placed, "placed")
    # Each task also learns the p of absent terms of all its sources, as a row without term.
    own = placed.select("lang", "no", "blocks", "block", F.lit(None).cast("string").alias("term"), F.col("base").alias("p"), F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"))
    there = cells.join(placed, ["lang", "source"]).select("lang", "no", "blocks", "block", "term", "p", F.pmod(F.xxhash64("term"), "slices").cast("int").alias("slice"))
    rows = own.unionByName(there).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("lang", "slice", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"), "no", "term", "p")
    schema = row_type(lang="string", u="long", w="long", part_sum="long", listed="long")

    def run(key: tuple, table: pa.Table) -> pa.Table:
        no = table["no"].to_numpy()
        absent = np.asarray(table["term"].is_null())
        base_no, base = no[absent], table["p"].to_numpy()[absent]
        order = np.argsort(base_no)
        base_no, base = base_no[order], base[order]
        terms = table["term"].combine_chunks().filter(pa.array(~absent)).dictionary_encode()
        row, column = np.searchsorted(base_no, no[~absent]), np.asarray(terms.indices)
        p = table["p"].to_numpy()[~absent]
        first = np.nonzero(base_no // BLOCK == key[2].as_py())[0]
        second = np.nonzero(base_no // BLOCK == key[3].as_py())[0]
        sums = np.zeros((len(first), len(second)), dtype=np.int64)
        for low in range(0, len(terms.dictionary), STRIP):
            inside = (column >= low) & (column < low + STRIP)
            shares = np.repeat(base[:, None], min(STRIP, len(terms.dictionary) - low), axis=1)
            shares[row[inside], column[inside] - low] = p[inside]
            for i, u in enumerate(first):
                sums[i] += np.abs(shares[second] - shares[u]).sum(axis=1)
        # Pairs of a source of one block with a later source of the other one.
        i, k = np.nonzero(base_no[first][:, None] < base_no[second][None, :])
        u, w, sums = base_no[first][i], base_no[second][k], sums[i, k]
        langs = pa.array([key[0].as_py()] * len(u), pa.string())
        listed = pa.array(np.full(len(u), len(terms.dictionary)), pa.int64())
        return pa.Table.from_arrays([langs, pa.array(u, pa.int64()), pa.array(w, pa.int64()), pa.array(sums, pa.int64()), listed], names=schema.names)

    partial = rows.groupBy("lang", "slice", "a", "b").applyInArrow(run, schema)
    summed = staged(partial.groupBy("lang", "u", "w").agg(F.sum("part_sum").alias("part_sum"), F.sum("listed").alias("listed")), "sums")
    side = lambda no, source, base: numbered.select("lang", F.col("no").cast("long").alias(no), F.col("source").alias(source), F.col("base").alias(base), "terms")
    both = summed.join(side("u", "one", "b1"), ["lang", "u"]).join(side("w", "two", "b2").drop("terms"), ["lang", "w"])
    value = F.col("part_sum") + (F.col("terms") - F.col("listed")) * F.abs(F.col("b1") - F.col("b2"))
    ends = F.array(*(F.struct(F.col(s).alias("source"), F.col(i).alias("item")) for s, i in (("one", "two"), ("two", "one"))))
    value = F.when(F.col("terms") > 0, value).otherwise(0).cast("long")
    return both.select("lang", F.explode(ends).alias("e"), value.alias("value")).select("lang", "e.source", "e.item", "value")


def divergence(docs: DataFrame, min_docs: int = 30, smooth: int = 5, scale: int = 1_000_000_000, top: int = 50) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``, as the module says.

    ``pair`` rows rank all other sources, ``term`` rows the ``top`` first terms; ties by item.
    """
    groups, kept, used = kept_counts(docs, min_docs)

    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    size = kept.groupBy("lang").agg(F.count("*").alias("terms"))
    of_lang = staged(used.groupBy("lang", "term").agg(F.sum("n").alias("lang_n")), "of_lang")
    totals = used.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    lang_totals = of_lang.groupBy("lang").agg(F.sum("lang_n").alias("lang_total"))
    sized = groups.join(totals, ["lang", "source"], "left").join(size, "lang", "left").join(lang_totals, "lang", "left")
    sized = sized.select("lang", "source", zero("total").alias("total"), zero("terms").alias("terms"), zero("lang_total").alias("lang_total"))
    base = F.when(F.col("terms") > 0, share(F.lit(0), F.col("total"), F.col("terms"), scale, smooth)).otherwise(0)
    sized = staged(sized.withColumn("base", base.cast("long")), "sized")

    p = share(F.col("n"), F.col("total"), F.col("terms"), scale, smooth)
    q = share(F.col("lang_n"), F.col("lang_total"), F.col("terms"), scale, smooth)
    cells = used.join(sized, ["lang", "source"]).join(of_lang, ["lang", "term"])
    cells = staged(cells.select("lang", "source", "term", p.cast("long").alias("p"), q.cast("long").alias("q")), "cells")

    more = cells.filter("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    term_rows = more.withColumn("rank", rank).filter(F.col("rank") <= top)
    pair_rows = pair_sums(cells.drop("q"), sized).withColumn("rank", rank)
    out = lambda rows, part: rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.col("rank").cast("int").alias("rank"))
    return out(pair_rows, "pair").unionByName(out(term_rows, "term"))
