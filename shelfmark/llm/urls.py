"""URL filters: a sorted array of digests, memory-mapped and probed by binary search."""

from __future__ import annotations

import tempfile
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.llm.common import lower_ascii
from shelfmark.session import cut


def url_parts(url: str) -> tuple[Column, Column]:
    """Host and path: from behind the first `://` to `/`, `?`, `#` or the end, A-Z lower-cased,
    and on from there to `?`, `#` or the end. Null or without `://`: both empty."""
    rest = F.when(F.instr(url, "://") > 0, F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)")).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return lower_ascii(F.regexp_extract(rest, "^([^/?#]*)", 1)), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


class DigestArray:
    """A set of strings as sorted 64-bit digests in a mapped file without a name, which goes
    with the task; a probe that meets a digest is confirmed by the stored string."""

    def __init__(self, strings: Iterable[str]):
        raw = sorted({s.encode() for s in strings}, key=lambda s: (xxhash.xxh64_intdigest(s), s))
        self.strings = raw
        self._file = tempfile.TemporaryFile()
        digests = np.array([xxhash.xxh64_intdigest(s) for s in raw], dtype="<u8")
        self._file.write(digests.tobytes())
        self._file.flush()
        self.digests = np.memmap(self._file, dtype="<u8", mode="r", shape=len(raw)) if raw else digests

    def places(self, keys: list[bytes]) -> np.ndarray:
        """For each key its place in the array, or -1."""
        probes = np.array([xxhash.xxh64_intdigest(k) for k in keys], dtype="<u8")
        first = np.searchsorted(self.digests, probes, "left")
        found = np.full(len(keys), -1)
        near = np.flatnonzero(first < len(self.strings))
        for k in near[self.digests[first[near]] == probes[near]].tolist():
            at = int(first[k])
            while at < len(self.strings) and self.digests[at] == probes[k]:
                if self.strings[at] == keys[k]:
                    found[k] = at
                    break
                at += 1
        return found


class Rule(NamedTuple):
    verdict: str
    rule: str

    @property
    def host(self) -> str:
        return self.rule.partition("/")[0].lower()

    @property
    def path(self) -> str:
        return "/" + self.rule.partition("/")[2]


def longest_rules(hosts: list[str], paths: list[str], rules: list[Rule], known: DigestArray) -> list[str | None]:
    """For each url the longest rule whose host is the url's or one above it and whose path
    begins the url's; of equally long ones that of the longer host. Every number of host labels
    and length of path that occurs in a rule is one vectorised probe of all urls."""
    best: list[str | None] = [None] * len(hosts)
    labels = [h.split(".") for h in hosts]
    for n in sorted({len(r.host.split(".")) for r in rules}):
        for size in sorted({len(r.path) for r in rules}):
            rows = [k for k in range(len(hosts)) if len(labels[k]) >= n and len(paths[k]) >= size]
            keys = [".".join(labels[k][-n:]) + paths[k][:size] for k in rows]
            for k, key, place in zip(rows, keys, known.places([x.encode() for x in keys]).tolist(), strict=True):
                if place >= 0 and len(key) >= len(best[k] or ""):
                    best[k] = key
    return best


#: Entries of a list that travel to the tasks at once; a longer list goes in as many passes over
#: the urls as it has such blocks.
BLOCK_ENTRIES = 200_000


def with_rules(rows: DataFrame, rules: list[Rule]) -> DataFrame:
    """All columns and rule, rule_verdict (null where none fits). Needs host and path."""
    verdicts = {r.host + r.path: r for r in rules}
    schema = T.StructType([*rows.schema.fields, T.StructField("rule", T.StringType()), T.StructField("rule_verdict", T.StringType())])
    names, places = schema.names, (rows.columns.index("host"), rows.columns.index("path"))

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = DigestArray(verdicts)
        for batch in batches:
            hosts, paths = (batch.column(k).to_pylist() for k in places)
            best = [verdicts.get(key) for key in longest_rules(hosts, paths, rules, known)]
            out = [pa.array([r and r.rule for r in best], pa.string()), pa.array([r and r.verdict for r in best], pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *out], names=names)

    return rows.mapInArrow(of_batches, schema)


def with_listed(rows: DataFrame, columns: tuple[str, ...], entries: DataFrame) -> DataFrame:
    """All columns and `listed`: whether the value of one of the string columns is an entry of
    the list, a table of one string column of any length; a null never is."""
    name = entries.columns[0]
    entries = cut(entries.where(F.col(name).isNotNull()).select(F.col(name).alias("entry")).distinct())
    blocks = max(1, -(-entries.count() // BLOCK_ENTRIES))
    rows = rows.withColumn("listed", F.lit(False))
    schema, places, names = rows.schema, [rows.columns.index(c) for c in columns], rows.columns
    for block in range(blocks):
        part = entries.where(F.pmod(F.xxhash64("entry"), F.lit(blocks)) == block)
        shared = rows.sparkSession.sparkContext.broadcast([r[0] for r in part.collect()])

        def of_batches(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            known = DigestArray(shared.value)
            for batch in batches:
                found = batch.column(len(names) - 1).to_numpy(zero_copy_only=False)
                for place in places:
                    hit = known.places([(v or "").encode() for v in batch.column(place).to_pylist()]) >= 0
                    found = found | hit & batch.column(place).is_valid().to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, pa.bool_())], names=names)

        rows = rows.mapInArrow(of_batches, schema)
    return rows


# Words that mark hosts and paths of gambling, pill, adult and link-farm sites.
UNWANTED = (
    "adult", "bet", "bets", "betting", "casino", "casinos", "cialis", "escort", "escorts", "gamble", "gambling", "jackpot",
    "keygen", "lottery", "payday", "pills", "poker", "porn", "porno", "sex", "slots", "spam", "viagra", "warez", "xxx",
)


def says(part: str, words: tuple[str, ...], between: str) -> Column:
    """Whether one of the words stands alone in a string, parted by the given characters."""
    return F.rlike(F.col(part), F.lit(rf"(^|[{between}])({'|'.join(words)})([{between}]|$)"))


def unwanted(pages: DataFrame, words: tuple[str, ...] = UNWANTED) -> DataFrame:
    """The block list that the urls of a table give: `entry` is a host whose name says one of the
    words, or the whole url of a page on another host whose path does. It grows with the table."""
    host, path = url_parts("url")
    rows = pages.select("url", host.alias("host"), lower_ascii(path).alias("path"))
    by_host = says("host", words, ".\\-")
    hosts = rows.where(by_host).select(F.col("host").alias("entry"))
    return hosts.union(rows.where(~by_host & says("path", words, "/._\\-")).select("url")).distinct()


def judge(pages: DataFrame, rules: list[Rule], listed: DataFrame) -> DataFrame:
    """A row for each page: page_id, host, path, rule, verdict, listed.

    verdict is that of the longest fitting rule; without one, block if the host or the whole url
    is an entry of the list (a table of one string column), else allow. Null urls and those
    without `://` have empty host and path, fit no rule and are allowed, unless listed. Repeated
    rows and null page_ids are judged each for itself; other columns are ignored. An empty table
    gives none."""
    host, path = url_parts("url")
    rows = pages.select("page_id", host.alias("host"), path.alias("path"), F.col("url").alias("url"))
    rows = with_listed(with_rules(rows, rules), ("host", "url"), listed)
    verdict = F.coalesce("rule_verdict", F.when(F.col("listed"), "block").otherwise("allow"))
    return rows.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "listed")
