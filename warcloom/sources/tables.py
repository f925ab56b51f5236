"""Reading written tables and listing their splits."""

from __future__ import annotations

import functools
import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from warcloom.functions.identity import split_name, split_partition

TABLE_SCHEMA = "key string, value string, table string, part int"
MANIFEST = "_manifest.json"
# A corpus has one file for each of its states in this folder; the last one counts.
VERSIONS = "_versions"
# Up to this many part folders are read by their paths; for more, whole tables are listed.
DIRECT_FOLDERS = 1_000

Ranges = list[list[int]]


@dataclass(frozen=True)
class Piece:
    """A folder of ``table=…/part=…`` folders, below ``base``, and the parts written there.

    ``parts`` has, for each table, ranges of part numbers; None if that isn't known.
    ``cuts`` has, for parts of several files, these files with their first keys.
    """

    folder: str
    base: str
    parts: dict[str, Ranges] | None = None
    cuts: dict[str, dict[str, list[list[str]]]] | None = None

    def numbers(self, table: str) -> set[int]:
        return {n for low, high in (self.parts or {}).get(table, []) for n in range(low, high + 1)}

    def paths(self, table: str, part: int, keys: list[str] | None) -> list[str]:
        """The folder of a part, or those of its files that can hold any of some keys."""
        folder = f"{self.folder}/table={table}/part={part}"
        files = (self.cuts or {}).get(table, {}).get(str(part))
        if not files or keys is None:
            return [folder]
        # A key may begin in one file and go on in the next ones. Keys are ordered by their bytes.
        first = [key.encode() for _, key in files] + [None]
        wanted = sorted(key.encode() for key in keys)
        reached = lambda low, high: any(low <= key and (high is None or key <= high) for key in wanted)
        return [f"{folder}/{name}" for (name, _), low, high in zip(files, first, first[1:]) if reached(low, high)]


@dataclass(frozen=True)
class Tables:
    """A written set of tables and what a reader has to know about it.

    ``order`` is the column that ranks repeats of a key, if there can be any, and
    ``inputs`` how many ranks there are. Opening lists no files: ``rows`` does, once it
    is asked for.
    """

    path: str
    num_partitions: int
    order: str | None
    given: DataFrame | None = None
    inputs: int = 1
    stated: tuple[tuple[str, str], ...] = ()
    pieces: tuple[Piece, ...] = ()
    spark: SparkSession | None = None

    @functools.cached_property
    def rows(self) -> DataFrame:
        """All rows: key, value, table, part, and the column that ranks repeats."""
        if self.given is not None:
            return self.given
        return self.read([(p.folder, p.base) for p in self.pieces])

    @property
    def columns(self) -> dict[str, str]:
        extra = {"segment": {"segment": "string"}, "ordinal": {"ordinal": "int"}}.get(self.order, {})
        return {"key": "string", "value": "string", "table": "string", "part": "int"} | extra

    def read(self, places: Iterable[tuple[str, str]]) -> DataFrame:
        """The rows in some folders or files, each with the folder that its partitions start from."""
        schema = ", ".join(f"{name} {kind}" for name, kind in self.columns.items())
        of_base: dict[str, list[str]] = {}
        for path, base in places:
            of_base.setdefault(base, []).append(path)
        reader = lambda base: self.spark.read.schema(schema).option("basePath", base)
        frames = [reader(base).parquet(*paths).select(*self.columns) for base, paths in of_base.items()]
        return reduce(DataFrame.unionByName, frames) if frames else self.spark.createDataFrame([], schema)

    def part_rows(self, table: str, parts: Iterable[int], keys: list[str] | None = None) -> DataFrame:
        """The rows of some parts of a table, of ``keys`` at least if these are given.

        Parts are addressed by path, so nothing else is listed, unless they are very many.
        """
        parts = sorted(parts)
        if self.given is None and all(p.parts is not None for p in self.pieces):
            places: list[tuple[str, str]] = []
            for piece in self.pieces:
                written = piece.numbers(table)
                for part in (n for n in parts if n in written):
                    places += [(path, piece.base) for path in piece.paths(table, part, keys)]
            rows = self.read(places) if len(places) <= DIRECT_FOLDERS else self.rows
        else:
            rows = self.rows
        rows = rows.filter(F.col("table") == table)
        return rows if len(parts) >= self.num_partitions else rows.filter(F.col("part").isin(parts))

    @functools.cached_property
    def types(self) -> tuple[tuple[str, str], ...]:
        """Types of key and value over the footers of all files, which tasks read; as stated without files."""
        found = {self._types_below(base) for base in {p.base for p in self.pieces}} - {None}
        if len(found) > 1:
            raise ValueError(f"types differ between the files of {self.path}: {sorted(found)}")
        return found.pop() if found else tuple(sorted(self.stated))

    def _types_below(self, base: str) -> tuple[tuple[str, str], ...] | None:
        folders = [p.folder for p in self.pieces if p.base == base]
        try:
            found = self.spark.read.option("mergeSchema", True).option("basePath", base).parquet(*folders).schema
        except (PySparkException, Py4JJavaError) as error:
            if "UNABLE_TO_INFER_SCHEMA" in str(error):
                return None
            if "CANNOT_MERGE_SCHEMAS" in str(error):
                raise ValueError(f"types differ between the files of {self.path}: {error}") from error
            raise
        return tuple((f.name, f.dataType.simpleString()) for f in found if f.name in dict(self.stated))

    @property
    def rank(self) -> Column:
        """The rank of a row among repeats of its key, from 0."""
        if self.order == "segment":
            return split_partition(F.col("segment"))
        return F.col("ordinal") if self.order == "ordinal" else F.lit(0)


def hadoop_path(spark: SparkSession, path: str):
    """A path and its filesystem, through Hadoop."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none if there is no such folder."""
    at, fs = hadoop_path(spark, path)
    if not fs.exists(at):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(at) if s.isDirectory())


def read_facts(spark: SparkSession, path: str) -> dict | None:
    """A JSON file, if there is one."""
    file, fs = hadoop_path(spark, path)
    if not fs.exists(file):
        return None
    stream = fs.open(file)
    facts = json.loads(bytes(stream.readAllBytes()))
    stream.close()
    return facts


def write_facts(spark: SparkSession, path: str, facts: dict, replace: bool = True) -> bool:
    """Store a JSON file under its name when it is complete; tells whether it is stored.

    Without ``replace``, a file that is there already stays, and this gives False.
    """
    folder, name = path.rsplit("/", 1)
    made, fs = hadoop_path(spark, f"{folder}/.{name}-{uuid.uuid4().hex}")
    stream = fs.create(made, True)
    stream.write(bytearray(json.dumps(facts, sort_keys=True).encode()))
    stream.close()
    jvm = spark._jvm.org.apache.hadoop.fs
    kinds = spark.sparkContext._gateway.new_array(jvm.Options.Rename, 1)
    kinds[0] = jvm.Options.Rename.OVERWRITE if replace else jvm.Options.Rename.NONE
    place = jvm.Path(path)
    context = jvm.FileContext.getFileContext(fs.makeQualified(place).toUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(fs.makeQualified(made), fs.makeQualified(place), kinds)
    except Exception:
        fs.delete(made, False)
        if replace or not fs.exists(place):
            raise
        return False
    return True


def written_parts(spark: SparkSession, path: str) -> dict[str, Ranges]:
    """Ranges of the part numbers that each table under a path has a folder for."""
    found = {}
    for table in (n for n in folder_names(spark, path) if n.startswith("table=")):
        ranges: Ranges = []
        for part in sorted(int(n[5:]) for n in folder_names(spark, f"{path}/{table}") if n.startswith("part=")):
            if ranges and ranges[-1][1] == part - 1:
                ranges[-1][1] = part
            else:
                ranges.append([part, part])
        found[table[6:]] = ranges
    return found


def write_manifest(spark: SparkSession, path: str, **facts) -> None:
    """Store a table's facts beside it, with the parts that are written."""
    facts.setdefault("types", {"key": "string", "value": "string"})
    if facts.get("order") != "segment":
        facts.setdefault("parts", written_parts(spark, path))
    write_facts(spark, f"{path}/{MANIFEST}", facts)


def latest_version(spark: SparkSession, path: str) -> tuple[int, dict | None]:
    """Number and facts of a corpus's last state; (0, None) if it has none."""
    at, fs = hadoop_path(spark, f"{path}/{VERSIONS}")
    names = [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []
    number = max((int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()), default=0)
    return number, read_facts(spark, f"{path}/{VERSIONS}/{number:08d}.json") if number else None


def live_folder(path: str, segment: str, facts: dict) -> str:
    """Where the tables of a segment lie that a corpus's state names."""
    return f"{path}/segment={segment}/generation={facts['segments'][segment]['generation']}"


def open_tables(spark: SparkSession, path: str) -> Tables:
    """Open tables written by this package: a set of tables, a corpus, or a segment of one."""
    path = path.rstrip("/")
    facts = read_facts(spark, f"{path}/{MANIFEST}")
    if facts is None:
        _, facts = latest_version(spark, path)
        if facts is not None:
            pieces = [Piece(live_folder(path, s, facts), path, known["parts"]) for s, known in sorted(facts["segments"].items())]
            return _opened(spark, path, facts, pieces)
        corpus, _, name = path.rpartition("/")
        _, facts = latest_version(spark, corpus) if name.startswith("segment=") else (0, None)
        if facts is None or name[8:] not in facts["segments"]:
            raise FileNotFoundError(f"no tables at {path}")
        folder = live_folder(corpus, name[8:], facts)
        return _opened(spark, folder, facts | {"order": None, "inputs": 1}, [Piece(folder, folder, facts["segments"][name[8:]]["parts"])])
    pieces = [Piece(path, path, facts.get("parts"), facts.get("cuts"))]
    for name in facts.get("added", {}):
        pieces.append(Piece(f"{path}/{name}", f"{path}/{name}", facts["added"][name]))
    return _opened(spark, path, facts, pieces)


def _opened(spark: SparkSession, path: str, facts: dict, pieces: list[Piece]) -> Tables:
    stated = facts.get("types", {"key": "string", "value": "string"})
    return Tables(
        path, facts["num_partitions"], facts.get("order"), None, facts.get("inputs", 1),
        tuple(sorted(stated.items())), tuple(pieces), spark,
    )


def check_parts(*every: Tables) -> None:
    """Raise if a part number does not fit its table's partition count.

    Where manifests don't tell the parts, one job finds them for all.
    """
    highest = {}
    for k, tables in enumerate(every):
        if tables.given is None and all(p.parts is not None for p in tables.pieces):
            highest[k] = max((high for p in tables.pieces for ranges in p.parts.values() for _, high in ranges), default=None)
    unknown = [t.rows.agg(F.max("part").alias("part")).withColumn("at", F.lit(k)) for k, t in enumerate(every) if k not in highest]
    if unknown:
        highest |= {at: part for part, at in reduce(DataFrame.union, unknown).collect()}
    for at, part in highest.items():
        if part is not None and part >= every[at].num_partitions:
            raise ValueError(f"part {part} does not fit {every[at].num_partitions} partitions: {every[at].path}")


def keep_table_splits(splits: DataFrame) -> DataFrame:
    """Keep the splits of the two tables, by the start of their name."""
    return splits.filter(F.col("name").rlike("^(data|uri)"))


def list_splits(spark: SparkSession, pattern: str) -> DataFrame:
    """Splits under a pattern: (name, path, part), one row per directory.

    Works for directories of Parquet tables and of map files; files are not read.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(pattern)
        .select("path")
    )
    folder = F.regexp_replace("path", "/[^/]+$", "")
    name = F.regexp_extract(folder, "([^/]+)$", 1)
    table = F.regexp_extract(folder, "/table=([^/]+)/part=[0-9]+$", 1)
    part = F.regexp_extract(folder, "/part=([0-9]+)$", 1)
    named = files.select(
        folder.alias("path"),
        F.when(table != "", split_name(table, part.try_cast("int"))).otherwise(name).alias("name"),
    ).distinct()
    in_table = keep_table_splits(named).filter(F.col("name").rlike(r"^\D+-\d+$"))
    return in_table.select("name", "path", split_partition(F.col("name")).alias("part"))


def distinct_splits(splits: DataFrame) -> DataFrame:
    """The set of paths under each split name, as the inputs of one merge.

    One row per name and path; a name's paths are never gathered into one value.
    """
    return splits.select("name", "path", "part").distinct()
