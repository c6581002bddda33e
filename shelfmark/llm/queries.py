"""The queries of the subpackage, each with production parameters on whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm import (
    bytepairs, codebooks, decontaminate, licenses, lines, merkle, packing, paragraphs, quality, simhash, toxicity, urls, vectors,
)
from shelfmark.llm.common import table
from shelfmark.session import cut

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(name: str, check: str | None = None) -> Callable:
    def keep(function: Callable) -> Callable:
        QUERIES[name] = function
        if check:
            CHECKS[name] = check
        return function

    return keep


@query("op2_simhash_near_dedup")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op6_packing")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence."""
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op10_toxicity")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score and prediction of every document."""
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op7_quality_classifier")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evidence, prior and decision for every document."""
    scored = quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "source", "lang", "evidence", "site", "prior", "score", "good")


# The rules of the contract.
URL_RULES = [
    urls.Rule("block", "net/"), urls.Rule("allow", "example.net/en/"),
    urls.Rule("block", "example.com/de/"), urls.Rule("allow", "org/fr/"),
]
_WORDS = "|".join(urls.UNWANTED)


@query("op3_url_filters", rf"""
with parts as (
    select page_id, case when contains(url, '://') then substr(url, strpos(url, '://') + 3) else '' end as rest from pages
), hosts as (
    select page_id, lower(regexp_extract(rest, '^([^/?#]*)', 1)) as host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
    from parts
), said as (
    select *, regexp_matches(host, '(^|[.\-])({_WORDS})([.\-]|$)')
        or regexp_matches(lower(path), '(^|[/._\-])({_WORDS})([/._\-]|$)') as listed
    from hosts
), rules(verdict, rule, rule_host, rule_path) as (
    values ('block', 'net/', 'net', '/'), ('allow', 'example.net/en/', 'example.net', '/en/'),
        ('block', 'example.com/de/', 'example.com', '/de/'), ('allow', 'org/fr/', 'org', '/fr/')
), fitting as (
    select page_id, r.rule, r.verdict, row_number() over (partition by page_id order by length(r.rule) desc) as place
    from hosts join rules r on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
)
select h.page_id, h.host, h.path, f.rule, h.listed,
    coalesce(f.verdict, case when h.listed then 'block' else 'allow' end) as verdict
from said h left join fitting f on f.page_id = h.page_id and f.place = 1
""")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page."""
    pages = table(spark, sf_dir, "pages")
    return urls.judge(pages, URL_RULES, urls.unwanted(pages))


@query("op8_license_scan")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences named in every document."""
    return licenses.scan(table(spark, sf_dir, "documents"))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@query("op4_benchmark_decontamination", rf"""
with d as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
    from documents
), b as (
    select item_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
    from benchmark
), sized as (
    select *, least(len(w), 10) as size from b where len(w) > 0
), windows as (
    select distinct item_id, size, array_to_string(w[i : i + size - 1], ' ') as words
    from (select *, unnest(range(1, len(w) - size + 2)) as i from sized)
), runs as (
    select doc_id, size, i, array_to_string(w[i : i + size - 1], ' ') as words
    from (
        select doc_id, w, size, unnest(range(1, len(w) - size + 2)) as i
        from d, (select distinct size from windows) where len(w) >= size
    )
), found as (
    select r.doc_id, r.i, r.size, x.item_id from runs r join windows x on r.words = x.words and r.size = x.size
), hit as (
    select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(i, i + size)) as p from found) group by doc_id
), items as (
    select doc_id, count(*) as n_items, string_agg(item_id, ',' order by item_id) as ids
    from (select distinct doc_id, cast(item_id as varchar) as item_id from found) group by doc_id
)
select d.doc_id, len(d.w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
    sha256(coalesce(ids, '')) as items_sha256, n_hit is not null as contaminated
from d left join hit using (doc_id) left join items using (doc_id)
""")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words, hit words and items of every document."""
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("matches")


@query("op5_line_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line that repeats another one, with the first of its class."""
    return lines.repeated_lines(table(spark, sf_dir, "documents"), shortest=1)


@query("op9_substring_dedup")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stretch of text that repeats another one, with the first of its class."""
    return paragraphs.repeats(table(spark, sf_dir, "documents"))


@query("op1_embedding_near_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector."""
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


# The checksum of a decimal id is computed bit by bit, as DuckDB has no function for it.
@query("op11_merkle_manifest", """
with recursive told as (
    select doc_id, source, text,
        concat(
            coalesce(strlen(cast(doc_id as varchar)) || ':' || cast(doc_id as varchar), '-'),
            coalesce(strlen(source) || ':' || source, '-'), coalesce(strlen(lang) || ':' || lang, '-'),
            coalesce(strlen(cast(n_chars as varchar)) || ':' || cast(n_chars as varchar), '-')
        ) as fields,
        list_reduce(
            list_concat([4294967295], list_transform(string_split(cast(doc_id as varchar), ''), lambda c: cast(ascii(c) as bigint))),
            lambda a, b: list_reduce(
                [xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1))
            )
        ) as crc
    from documents
), leaves as (
    select doc_id, source, sha256(fields || coalesce(strlen(text) || ':' || text, '-')) as leaf,
        case when (xor(crc, 4294967295) & 1) = 0 and text is not null
            then sha256(fields || strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), ''))
            else sha256(fields || coalesce(strlen(text) || ':' || text, '-')) end as claim
    from told
), placed as (
    select *, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as place from leaves
), low as (
    select source, 0 as height, place, leaf as digest, count(*) over (partition by source) as n from placed
    union all
    select source, height + 1, place // 3, sha256(string_agg(digest, '' order by place)), (n + 2) // 3
    from low where n > 1 group by source, height, place // 3, n
), subroots as (
    select source, digest as subroot, row_number() over (order by source nulls first) - 1 as place from low where n = 1
), high as (
    select 0 as height, place, subroot as digest, count(*) over () as n from subroots
    union all
    select height + 1, place // 3, sha256(string_agg(digest, '' order by place)), (n + 2) // 3
    from high where n > 1 group by height, place // 3, n
), low_sides as (
    select a.source, a.height, a.place,
        coalesce(string_agg(b.digest, '' order by b.place) filter (where b.place < a.place), '') as l,
        coalesce(string_agg(b.digest, '' order by b.place) filter (where b.place > a.place), '') as r
    from low a join low b on a.source is not distinct from b.source and a.height = b.height and a.place // 3 = b.place // 3
    where a.n > 1 group by a.source, a.height, a.place
), high_sides as (
    select a.height, a.place,
        coalesce(string_agg(b.digest, '' order by b.place) filter (where b.place < a.place), '') as l,
        coalesce(string_agg(b.digest, '' order by b.place) filter (where b.place > a.place), '') as r
    from high a join high b on a.height = b.height and a.place // 3 = b.place // 3
    where a.n > 1 group by a.height, a.place
), sides as (
    select p.source, p.place, 0 as tree, s.height, s.l, s.r
    from placed p join low_sides s on p.source is not distinct from s.source and s.place = p.place // cast(pow(3, s.height) as bigint)
    union all
    select p.source, p.place, 1, s.height, s.l, s.r
    from placed p join subroots t on p.source is not distinct from t.source
    join high_sides s on s.place = t.place // cast(pow(3, s.height) as bigint)
), paths as (
    select source, place, string_agg(l || r, '' order by tree, height) as proof,
        list({'l': l, 'r': r} order by tree, height) as path
    from sides group by source, place
), folds as (
    select p.doc_id, p.leaf, t.subroot, (select digest from high where n = 1) as root, sha256(coalesce(x.proof, '')) as proof_sha256,
        list_reduce(
            list_concat([{'l': p.claim, 'r': ''}], coalesce(x.path, [])),
            lambda a, s: {'l': sha256(s.l || a.l || s.r), 'r': ''}
        ).l as folded_root
    from placed p join subroots t on p.source is not distinct from t.source
    left join paths x on p.source is not distinct from x.source and p.place = x.place
)
select *, folded_root = root as verified from folds
""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in the manifest, and whether a copy that lost its line ends in
    every second document (by the checksum of its id) still belongs."""
    docs = table(spark, sf_dir, "documents")
    lost = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    altered = F.when(lost, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return merkle.verified(docs, altered)


def _codes_check() -> str:
    """Brute force: every part against every entry, round by round."""
    sql = """
with kept as (
    select row_number() over (order by vec_id nulls last, embedding) as row, vec_id, label, embedding from embeddings
    where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), flat as (
    select row, vec_id, label, unnest(embedding) as x, unnest(range(len(embedding))) as i, len(embedding) // 16 as wide from kept
), cells as (
    select row, i // wide as part, i % wide as pos, cast(floor(cast(x as double) * 256) as bigint) as v from flat
), books0 as (
    select row - 1 as entry, part, pos, v from cells where row <= 64
)"""
    for k in range(codebooks.ROUNDS + 1):
        sql += f""", far{k} as (
    select c.row, c.part, b.entry, sum((c.v - b.v) * (c.v - b.v)) as d
    from cells c join books{k} b on c.part = b.part and c.pos = b.pos group by c.row, c.part, b.entry
), near{k} as (
    select row, part, entry, d from far{k} qualify row_number() over (partition by row, part order by d, entry) = 1
)"""
        if k < codebooks.ROUNDS:
            sql += f""", sums{k} as (
    select n.part, n.entry, c.pos, sum(c.v) as total, count(*) as n
    from near{k} n join cells c on c.row = n.row and c.part = n.part group by n.part, n.entry, c.pos
), books{k + 1} as (
    select b.entry, b.part, b.pos,
        cast(coalesce((s.total - ((s.total % s.n) + s.n) % s.n) // s.n, b.v) as bigint) as v
    from books{k} b left join sums{k} s on b.part = s.part and b.entry = s.entry and b.pos = s.pos
)"""
    last = codebooks.ROUNDS
    return sql + f""", coded as (
    select row, string_agg(printf('%02x', entry), '' order by part) as code, cast(sum(d) as bigint) as error from near{last} group by row
), books as (
    select sha256(string_agg(cast(v as varchar), ',' order by part, entry, pos)) as codebooks_sha256 from books{last}
)
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error, codebooks_sha256
from kept join coded using (row), books"""


@query("op12_vector_codes", _codes_check())
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code and error of every usable vector, and the error of all vectors of its label."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    coded, books = codebooks.codes(vectors)
    found = codebooks.with_group_error(cut(coded.select("vec_id", "label", "code", "error")))
    return found.select("vec_id", "code", "error", "label_error", F.lit(books.sha256() if books else "").alias("codebooks_sha256"))


@query("op13_byte_bpe")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids and of what they decode to."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    both = bytepairs.decode(bytepairs.encode(docs, path, public_tokenizers.PATTERN), path)
    return both.select(
        "doc_id", F.expr("octet_length(ids) div 4").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
