"""URL filter over a sorted array of 64-bit digests.

Rules are (host, path, verdict). A rule fits its host and all subdomains if the url's path starts with the rule's path;
the longest ``host + path`` wins, of equally long ones that with the longer host. A url that no rule fits has the
default verdict.

The rules' strings are hashed with xxHash64 (``xxhash64`` of Spark, seed 42), and the digests stored as one sorted array
with the strings beside it. Each executor gets the files once and maps them into memory, so all its tasks share one
copy and only probed pages are read. Spark's own expressions take a url apart into candidate keys, every parent domain
with every path length that occurs among the rules, and hash them; per batch one vectorised binary search probes all
candidates. A digest that is found counts only if the stored full string is equal, and equal digests of different
strings lie side by side and are all compared.

The files are bounded: a rule list beyond ``max_bytes`` is not shipped but cut into ranges of digests, each small enough for
one task. The distinct candidates go to the range of their digest, where the task holds that range's sorted array and
probes it by the same binary search, batch by batch; what is found goes back to the urls by a join.

Defined cases: a null url and one without ``://`` have an empty host and path, no rule and the default verdict. Rules
with a null or empty host never fit; a null path counts as empty; equal rules count once, block before allow.
Repeated rows and null page_ids are judged like others. Extra columns are ignored. Empty tables give empty results; no
rules, the default.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import stage

MAX_BYTES = 256 << 20
RANGE_BYTES = 16 << 20  # of rules that one task holds where the list is cut into ranges
RULE_COLUMNS = "host string, path string, verdict string"


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return _lowered(host)


def _lowered(host: Column) -> Column:
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def parsed(pages: DataFrame, url: str = "url") -> DataFrame:
    text = F.col(url).cast("string")
    return pages.withColumns({"host": host_of(text), "path": path_of(text)})


def _suffixes(host: Column) -> Column:
    """The host and all its parent domains."""
    labels = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))


def _key(host: Column, path: Column) -> Column:
    """Host and path as one string that tells where the host ends."""
    return F.concat(F.char_length(host).cast("string"), F.lit(":"), host, path)


def _shown(key: str) -> str:
    return key.split(":", 1)[1]


def candidate_keys(host: Column, path: Column, path_lengths: list[int]) -> Column:
    """Keys of every rule that could fit, given the lengths of the rules' paths."""
    starts = F.array(*[F.substring(path, 1, n) for n in path_lengths]) if path_lengths else F.array().cast("array<string>")
    fitting = F.array_distinct(starts)
    return F.flatten(F.transform(_suffixes(host), lambda h: F.transform(fitting, lambda p: _key(h, p))))


def clean_rules(rules: DataFrame) -> DataFrame:
    """key, host_length, path_length, verdict and digest; equal rules once, block before allow."""
    own = rules.select(_lowered(F.col("host")).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict").where("host is not null and host != ''")
    keyed = own.groupBy(_key(F.col("host"), F.col("path")).alias("key")).agg(
        F.max("verdict").alias("verdict"), F.max(F.char_length("host")).alias("host_length"), F.max(F.char_length("path")).alias("path_length"))
    return keyed.withColumn("digest", F.xxhash64("key"))


def write_array(rules: DataFrame, folder: str) -> None:
    """Sorted digests, string ends, strings, verdicts and host lengths as files; rows arrive one partition at a time."""
    with open(f"{folder}/digests", "wb") as digests, open(f"{folder}/ends", "wb") as ends, open(f"{folder}/strings", "wb") as strings, \
            open(f"{folder}/blocks", "wb") as blocks, open(f"{folder}/hosts", "wb") as hosts:
        end = 0
        for r in rules.orderBy("digest", "key").toLocalIterator():
            text = r.key.encode()
            end += len(text)
            digests.write(np.int64(r.digest).tobytes())
            ends.write(np.int64(end).tobytes())
            strings.write(text)
            blocks.write(bytes([r.verdict == "block"]))
            hosts.write(np.int32(r.host_length).tobytes())


class RuleArray:
    """Sorted digests with the strings they come from; ``ends`` says where each string ends."""

    def __init__(self, digests: np.ndarray, ends: np.ndarray, strings: np.ndarray):
        self.digests, self.ends, self.strings = digests, ends, strings

    def key(self, i: int) -> str:
        return self.strings[self.ends[i - 1] if i else 0:self.ends[i]].tobytes().decode()

    def find(self, digests: np.ndarray, keys: pa.Array) -> np.ndarray:
        """Number of the rule equal to each key, or -1."""
        found = np.full(len(digests), -1, np.int64)
        low = np.searchsorted(self.digests, digests, "left")
        high = np.searchsorted(self.digests, digests, "right")
        for c in np.flatnonzero(high > low):  # only these are compared in full
            text = keys[c].as_py()
            for i in range(low[c], high[c]):
                if self.key(i) == text:
                    found[c] = i
        return found


class DigestArray(RuleArray):
    """The mapped files of ``write_array``."""

    def __init__(self, folder: str):
        def mapped(name: str, kind: type) -> np.ndarray:
            path = f"{folder}/{name}"
            return np.memmap(path, kind, "r") if os.path.getsize(path) else np.zeros(0, kind)
        super().__init__(mapped("digests", np.int64), mapped("ends", np.int64), mapped("strings", np.uint8))
        self.blocks, self.hosts = mapped("blocks", np.uint8), mapped("hosts", np.int32)


_OUT = "page_id long, host string, path string, rule string, verdict string"


def _probe(archive: str, default: str):
    schema = pa.schema([("page_id", pa.int64()), *[(n, pa.string()) for n in ("host", "path", "rule", "verdict")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        array = DigestArray(SparkFiles.get(archive))
        for batch in batches:
            keys, digests = batch.column("keys"), batch.column("digests")
            rows = keys.value_parent_indices().to_numpy()
            found = array.find(digests.flatten().to_numpy(), keys.flatten())
            rule: list[str | None] = [None] * batch.num_rows
            verdict, best = [default] * batch.num_rows, {}
            for c in np.flatnonzero(found >= 0):
                row, i, text = int(rows[c]), int(found[c]), _shown(array.key(int(found[c])))
                rank = len(text), int(array.hosts[i])
                if rank > best.get(row, (-1, -1)):
                    best[row], rule[row], verdict[row] = rank, text, "block" if array.blocks[i] else "allow"
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("host"), batch.column("path"), pa.array(rule, pa.string()),
                                              pa.array(verdict, pa.string())], schema=schema)
    return run


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", max_bytes: int = MAX_BYTES) -> DataFrame:
    """page_id, host, path, rule (the winning ``host + path``, else null) and verdict of every page."""
    spark = pages.sparkSession
    rules = clean_rules(rules)
    size = rules.agg(F.coalesce(F.sum(F.octet_length("key") + 21), F.lit(0)).alias("n")).first().n
    lengths = sorted(r.path_length for r in rules.select("path_length").distinct().collect())
    urls = parsed(pages).select(F.col("page_id").cast("long").alias("page_id"), "host", "path")
    probes = urls.withColumn("keys", candidate_keys(F.col("host"), F.col("path"), lengths))
    if size > max_bytes:
        return _judged_by_range(probes, rules, default, -(-size // RANGE_BYTES))
    archive = f"rules-{uuid.uuid4().hex}"
    folder = tempfile.mkdtemp(prefix="rules-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)  # the driver serves the archive for as long as it lives
    os.mkdir(f"{folder}/{archive}")
    write_array(rules, f"{folder}/{archive}")
    spark.sparkContext.addArchive(f"{shutil.make_archive(f'{folder}/{archive}', 'zip', f'{folder}/{archive}')}#{archive}")
    return probes.withColumn("digests", F.transform("keys", lambda k: F.xxhash64(k))).mapInArrow(_probe(archive, default), _OUT)


_FOUND = "key string, host_length int, path_length int, verdict string"


def _probe_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The candidates among rows sorted with rules (no probes) first and by digest, that are rules."""
    rules: list[pa.RecordBatch] = []
    array = held = None
    for batch in batches:
        first = batch.column("probe").to_numpy(zero_copy_only=False).searchsorted(True)
        if first:
            rules.append(batch.slice(0, first))
        probes = batch.slice(first)
        if not probes.num_rows or not rules:
            continue
        if array is None:
            held = pa.Table.from_batches(rules).combine_chunks()
            texts = held.column("key").cast(pa.large_binary()).combine_chunks()
            ends = np.cumsum(pc.binary_length(texts).to_numpy())
            array = RuleArray(held.column("digest").to_numpy(), ends, np.frombuffer(b"".join(texts.to_pylist()), np.uint8))
        found = array.find(probes.column("digest").to_numpy(), probes.column("key"))
        yield from held.take(pa.array(found[found >= 0])).select(["key", "host_length", "path_length", "verdict"]).to_batches()


def _judged_by_range(probes: DataFrame, rules: DataFrame, default: str, ranges: int) -> DataFrame:
    """The same for rule lists too large to ship: every distinct candidate is looked up in the range of its digest."""
    rows = stage(probes.withColumn("row", F.monotonically_increasing_id()), "urls")  # numbered once, by writing
    each = rows.select("row", F.explode(F.array_distinct("keys")).alias("key"))
    asked = each.select("key").distinct().select(F.xxhash64("key").alias("digest"), "key", F.lit(True).alias("probe"))
    stored = rules.select("digest", "key", F.lit(False).alias("probe"), "host_length", "path_length", "verdict")
    placed = stored.unionByName(asked, allowMissingColumns=True).repartitionByRange(ranges, "digest").sortWithinPartitions("probe", "digest", "key")
    found = placed.mapInArrow(_probe_range, _FOUND)
    best = each.join(found, "key").groupBy("row").agg(
        F.max(F.struct((F.col("host_length") + F.col("path_length")).alias("n"), "host_length", "key", "verdict")).alias("best"))
    return rows.join(best, "row", "left").select("page_id", "host", "path", F.regexp_replace("best.key", "^[0-9]+:", "").alias("rule"),
                                                 F.coalesce("best.verdict", F.lit(default)).alias("verdict"))


def oracle_sql(rules: list[tuple[str, str, str]], default: str = "allow") -> str:
    """The same verdicts for another SQL engine."""
    values = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in rules)
    host = "translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH r(rh, rp, v) AS (VALUES {values}),
u AS (SELECT row_number() OVER () AS k, page_id, {host} AS host,
             regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
best AS (SELECT k, arg_max(rh || rp, length(rh || rp) * 10000 + length(rh)) AS rule, arg_max(v, length(rh || rp) * 10000 + length(rh)) AS v
         FROM u JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY k)
SELECT page_id, host, path, rule, coalesce(v, '{default}') AS verdict FROM u LEFT JOIN best USING (k)"""
