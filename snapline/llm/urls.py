"""URL filter: rules by host and path prefix, looked up in a sorted array of 64-bit xxhash digests.

Each URL is looked up as every (parent domain, path prefix of a length that rules have) it has. The digests of all rules lie
sorted in a file that tasks map into memory and search by vectorised bisection; a found digest counts only if the stored rule
text is equal, so colliding digests change nothing. The longest fitting rule wins, of equally long ones that with the longer host;
of one rule with two verdicts, block. Where no rule fits, a second array decides: a block list of hosts (with their subdomains) and
url prefixes.

The arrays are written from Arrow chunks of a range of digests each, so the driver never holds more than one chunk of rules.

Defined results: a missing URL or one without ``://`` has empty host and path, which nothing fits; it is allowed. Path prefixes
are compared as text, without decoding. Repeated rows get equal results; no rows, no result. Only ``page_id`` and ``url`` are read.
"""

from __future__ import annotations

import math
import os
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import ExitStack

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from snapline.llm.common import stored, table

#: The rules of the registered query. Fixed values: (host and path, verdict).
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
#: Rules in one array, about 100 bytes each; more are joined by their digest instead.
ARRAY_RULES = 5_000_000
#: Rules that the driver holds at a time while it writes an array, about.
CHUNK_RULES = 200_000
#: Names that make a host suspect; fixed values.
SUSPECT = r"(^|[.-])(spam|phish|malware|casino|xxx|porn|warez)"
# Folders of the files that Spark's driver serves; executors may ask for them as long as the driver lives.
_served: list[tempfile.TemporaryDirectory] = []
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


class DigestArray:
    """Rules sorted by digest: digests, then for each the place of its text and verdict."""

    TYPES = {"digests": np.uint64, "ends": np.int64, "texts": np.uint8, "blocked": np.uint8}

    @classmethod
    def write(cls, folder: str, rules: list[tuple[str, str]]) -> dict[str, str]:
        """The array of a few rules as files."""
        digests = np.array([xxhash.xxh64_intdigest(r.encode(), seed=42) for r, _ in rules], np.uint64)
        order = np.argsort(digests, kind="stable")
        return cls.write_chunks(folder, [(digests[order], pa.array([rules[i][0] for i in order], pa.large_string()), np.array([rules[i][1] == "block" for i in order]))])

    @classmethod
    def write_chunks(cls, folder: str, chunks: Iterable[tuple[np.ndarray, pa.Array, np.ndarray]]) -> dict[str, str]:
        """The array as files, named apart from any other array's, from (digests, texts, blocked) in order of digest."""
        tag, end = uuid.uuid4().hex, 0
        names = {part: os.path.join(folder, f"url-{part}-{tag}.bin") for part in cls.TYPES}
        with ExitStack() as stack:
            files = {part: stack.enter_context(open(name, "wb")) for part, name in names.items()}

            def put(**values: np.ndarray) -> None:
                for part, some in values.items():
                    files[part].write(np.ascontiguousarray(some, cls.TYPES[part]).data)

            put(ends=np.zeros(1))
            for digests, texts, blocked in chunks:
                lengths = np.array(pc.binary_length(texts), np.int64)
                data = b"".join(text.encode() for text in texts.to_pylist())
                ends = end + np.cumsum(lengths)
                put(digests=digests, ends=ends, texts=np.frombuffer(data, np.uint8), blocked=blocked)
                end += len(data)
        return names

    def __init__(self, names: dict[str, str]):
        def mapped(part: str) -> np.ndarray:
            kind = self.TYPES[part]
            return np.memmap(names[part], kind, "r") if os.path.getsize(names[part]) else np.empty(0, kind)

        self.digests, self.ends, self.texts, self.blocked = (mapped(p) for p in self.TYPES)

    def find(self, probes: list[bytes]) -> list[int | None]:
        """For each probe 1 (block), 0 (allow), or None if no rule has this text."""
        wanted = np.array([xxhash.xxh64_intdigest(p, seed=42) for p in probes], np.uint64)
        low = np.searchsorted(self.digests, wanted, "left")
        high = np.searchsorted(self.digests, wanted, "right")
        found: list[int | None] = [None] * len(probes)
        for i in np.flatnonzero(high > low):
            for at in range(low[i], high[i]):  # more than one only where digests collide
                if self.texts[self.ends[at] : self.ends[at + 1]].tobytes() == probes[i]:
                    found[i] = max(found[i] or 0, int(self.blocked[at]))
        return found


def probes_of(host: str, path: str, lengths: list[int]) -> list[str]:
    """Rule texts that would fit, the longest first; ``lengths`` of the rules' paths in code points."""
    labels = host.split(".") if host else []
    hosts = [".".join(labels[i:]) for i in range(len(labels))]
    paths = [path[:n] for n in lengths if n <= len(path)]
    return sorted((h + p for h in hosts for p in paths), key=len, reverse=True)


def distinct_rules(rules: DataFrame) -> DataFrame:
    """rule, verdict and path length of each rule, once."""
    known = rules.filter("rule IS NOT NULL AND verdict IN ('block', 'allow')").groupBy("rule").agg(F.max(F.col("verdict") == "block").alias("blocked"))
    length = F.length("rule") - F.length(F.substring_index("rule", "/", 1))
    return stored(known.select("rule", F.when(F.col("blocked"), "block").otherwise("allow").alias("verdict"), length.alias("length")), "url-rules")


def chunks_of(rules: DataFrame, rows: int, chunk_rules: int) -> Iterator[tuple[np.ndarray, pa.Array, np.ndarray]]:
    """``rows`` stored rules as Arrow chunks of equal ranges of digests, in order of digest; digests spread evenly."""
    bits = max(0, math.ceil(math.log2(max(rows, 1) / chunk_rules)))
    # With the sign bit turned over, signed order is the order of unsigned digests.
    turned = F.xxhash64("rule").bitwiseXOR(F.lit(-(2**63)))
    digested = rules.select("rule", (F.col("verdict") == "block").alias("blocked"), turned.alias("digest"))
    for chunk in range(-(2**bits) // 2, 2**bits // 2) if bits else [None]:
        part = digested if chunk is None else digested.filter(F.shiftright("digest", 64 - bits) == chunk)
        got = part.orderBy("digest", "rule").toArrow().combine_chunks()
        digests = got["digest"].to_numpy().astype(np.int64).view(np.uint64) ^ np.uint64(2**63)
        yield digests, pa.concat_arrays(got["rule"].chunks) if got.num_rows else pa.array([], pa.string()), got["blocked"].to_numpy()


def match_rules(pages: DataFrame, rules: DataFrame, array_rules: int = ARRAY_RULES, chunk_rules: int = CHUNK_RULES) -> DataFrame:
    """``page_id``, host, path, rule and ruled (the rule's verdict) of each page; ``rules``: (rule, verdict)."""
    rows = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    return _matched(rows, rules, array_rules, chunk_rules)


def _matched(rows: DataFrame, rules: DataFrame, array_rules: int, chunk_rules: int) -> DataFrame:
    """``rows`` (page_id, host and path first) with rule and ruled."""
    spark = rows.sparkSession
    rules = distinct_rules(rules)
    lengths = [r[0] for r in rules.select("length").distinct().orderBy("length").collect()]  # as many as rule paths have lengths
    number = rules.count()
    if number > array_rules:
        return _joined(rows, rules, lengths)
    folder = tempfile.TemporaryDirectory(prefix="url-rules-")
    _served.append(folder)
    names = DigestArray.write_chunks(folder.name, chunks_of(rules, number, chunk_rules))
    for path in names.values():
        spark.sparkContext.addFile(path)
    files = {part: os.path.basename(path) for part, path in names.items()}

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        array = DigestArray({part: SparkFiles.get(name) for part, name in files.items()})
        for batch in batches:
            hosts, paths = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            probes = [probes_of(h, p, lengths) for h, p in zip(hosts, paths)]
            flat = [p.encode() for own in probes for p in own]
            found, at = array.find(flat), 0
            rule, ruled = [], []
            for own in probes:
                hit = next((i for i in range(len(own)) if found[at + i] is not None), None)
                rule.append(None if hit is None else own[hit])
                ruled.append(None if hit is None else ("block" if found[at + hit] else "allow"))
                at += len(own)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rule, pa.string()), pa.array(ruled, pa.string())], [*names_in, "rule", "ruled"])

    names_in = rows.columns
    return rows.mapInArrow(look_up, StructType([*rows.schema.fields, StructField("rule", StringType()), StructField("ruled", StringType())]))


def _joined(rows: DataFrame, rules: DataFrame, lengths: list[int]) -> DataFrame:
    """The same for any number of rules: distinct probes meet the rules in a join, by digest and text."""
    rows = stored(rows.withColumn("_row", F.monotonically_increasing_id()), "url-rows")
    labels = F.split("host", r"\.")
    hosts = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels) - i + 1), "."))
    paths = F.filter(F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths]).cast("array<string>"), lambda p: p.isNotNull())
    probes = rows.filter("host <> ''").select("_row", F.explode(hosts).alias("_host"), paths.alias("_paths")).select("_row", F.explode(F.transform("_paths", lambda p: F.concat("_host", p))).alias("probe"))
    rules = rules.select("rule", "verdict", F.xxhash64("rule").alias("_digest"))
    hits = probes.join(rules, (F.xxhash64("probe") == F.col("_digest")) & (F.col("probe") == F.col("rule")))
    host = F.length(F.substring_index("rule", "/", 1))
    best = hits.groupBy("_row").agg(F.max(F.struct(F.length("rule").alias("length"), host.alias("host"), "rule", "verdict")).alias("best"))
    return rows.join(best, "_row", "left").select(*[c for c in rows.columns if c != "_row"], F.col("best.rule").alias("rule"), F.col("best.verdict").alias("ruled"))


def suspect_hosts(pages: DataFrame) -> DataFrame:
    """A block list (rule, verdict) of the hosts among the pages that have a suspect name, each once."""
    hosts = pages.select(host_of(F.col("url")).alias("host")).filter(F.col("host").rlike(SUSPECT)).distinct()
    return hosts.select(F.concat("host", F.lit("/")).alias("rule"), F.lit("block").alias("verdict"))


def judge(pages: DataFrame, rules: DataFrame, array_rules: int = ARRAY_RULES, blocked: DataFrame | None = None, chunk_rules: int = CHUNK_RULES) -> DataFrame:
    """page_id, host, path, rule and verdict; where no rule fits, the block list's, else allow.

    ``blocked``: (rule, verdict) of hosts and url prefixes, ``host/path``; without it the hosts with a suspect name.
    A host of the list counts for urls without a path too.
    """
    listed = suspect_hosts(pages) if blocked is None else blocked
    rows = match_rules(pages, rules, array_rules, chunk_rules).withColumnsRenamed({"rule": "own_rule", "ruled": "own"})
    asked = rows.withColumns({"path": F.when(F.col("path") == "", "/").otherwise(F.col("path")), "own_path": F.col("path")})
    rows = _matched(asked, listed, array_rules, chunk_rules)
    return rows.select("page_id", "host", F.col("own_path").alias("path"), F.col("own_rule").alias("rule"), F.coalesce("own", "ruled", F.lit("allow")).alias("verdict"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"), spark.createDataFrame(RULES, "rule string, verdict string"))
