"""The registered queries of the training-data operators; each with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from estrato.llm.common import is_fold, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from estrato.llm import quality

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.learn(docs, table(spark, sf_dir, "labels"))
    scored = quality.quality_scores(docs, model)
    return scored.select(
        "doc_id", is_fold("doc_id", quality.FOLDS, quality.HELD_OUT).alias("held_out"), "score", "predicted"
    )


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from estrato.llm import toxicity

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.toxicity_scores(docs, model)
    held = is_fold("doc_id", toxicity.FOLDS, toxicity.HELD_OUT).alias("held_out")
    return scored.select("doc_id", held, "score", "predicted", "terms", "nearest")


def op4_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from estrato.llm import lm

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model, counts = lm.learn(lm.training(docs))
    scored = lm.score_texts(docs, model, counts)
    return scored.withColumn("held_out", is_fold("doc_id", lm.FOLDS, lm.HELD_OUT))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from estrato.llm.token_count import token_counts

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts(docs)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from estrato.llm.mixing import cyclic_weight, mix, ranked_sources

    def weight(sources: DataFrame) -> DataFrame:
        return ranked_sources(sources).withColumn("weight", cyclic_weight(3, 1, 2)).drop("rank")

    mixed = mix(table(spark, sf_dir, "documents"), weight)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


#: The water level is that of the first k sources, in order of cap by weight, at their cap
#: for which the next source is below its own.
OP2_SQL = r"""
with rows as (
  select doc_id, source, md5('mix:' || coalesce(cast(doc_id as varchar), 'null')) as k,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size
  from documents
), src as (
  select source, sum(size)::bigint as source_size,
    [3, 1, 2][((row_number() over (order by source nulls last) - 1) % 3 + 1)::int] as w
  from rows group by source
), lv as (
  select *, row_number() over o2 as k, coalesce(sum(2 * source_size) over o, 0)::bigint as c,
    (select sum(w) from src)::bigint - coalesce(sum(w) over o, 0)::bigint as rest_w
  from src
  window o as (order by 2.0 * source_size / w, source nulls last rows between unbounded preceding and 1 preceding),
    o2 as (order by 2.0 * source_size / w, source nulls last)
), level as (
  select arg_min((1.5::double * (select sum(source_size) from src)::double - c::double) / rest_w::double, k) as l
  from lv
  where (1.5::double * (select sum(source_size) from src)::double - c::double) / rest_w::double * w < 2.0::double * source_size
), goal as (
  select source, source_size, least(2.0::double * source_size, l * w) as target
  from src, level
), cut as (
  select *, case when source_size > 0 then floor(round(target) / source_size)::bigint else 0 end as whole
  from goal
), placed as (
  select doc_id, size, source_size, target, whole, round(target)::bigint - whole * source_size as rest,
    coalesce(sum(size) over (partition by r.source order by k, size rows between unbounded preceding and 1 preceding), 0)::bigint as start
  from rows r join cut c on r.source is not distinct from c.source
)
select doc_id, size, source_size, target,
  (size * whole + greatest(0, least(size, rest - start)))::bigint as taken
from placed
"""


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from estrato.llm.decontamination import leaks

    found = leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("text_hash")


def op7_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    from estrato.llm.substring_dedup import dedup

    return dedup(table(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from estrato.llm.packing import pack

    return pack(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from estrato.llm.simhash import hex_of, near_duplicates

    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", hex_of().alias("fingerprint"), "component_id")


def op10_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    from estrato.llm.embeddings import near_duplicates

    return near_duplicates(table(spark, sf_dir, "embeddings"))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    from estrato.llm.phrases import collocations

    return collocations(table(spark, sf_dir, "documents"))


OP11_SQL = r"""
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as p
  from documents
), words as (
  select lang, regexp_extract_all(p, '[^\x20\x09]+') as w from pieces
), runs as (
  select lang, unnest(flatten(list_transform(range(1, 5), lambda k:
    list_transform(range(1, len(w) - k + 2), lambda i: w[i:i + k - 1])))) as p from words
), f as (
  select lang, p, count(*) as a from runs group by lang, p
), total as (
  select lang, sum(a)::bigint as n from f where len(p) = 1 group by lang
), cand as (
  select lang, p, a from f where len(p) > 1 and a >= 30
), cuts as (
  select c.lang, c.p, c.a, k, x.a as l, y.a as r, (2000000::hugeint * c.a // (x.a + y.a))::bigint as score
  from (select *, unnest(range(1, len(p))) as k from cand) c
  join f x on x.lang = c.lang and x.p = c.p[1:k]
  join f y on y.lang = c.lang and y.p = c.p[k + 1:len(c.p)]
), best as (
  select * from cuts qualify row_number() over (partition by lang, p order by score, k) = 1
), inside as (
  select lang, p, max(a) as longer from (
    select lang, a, unnest(flatten(list_transform(range(2, len(p)), lambda k:
      list_transform(range(1, len(p) - k + 2), lambda i: p[i:i + k - 1])))) as p from cand
  ) group by lang, p
), ranked as (
  select b.*, array_to_string(b.p, ' ') as phrase, row_number() over (
    partition by b.lang order by score desc, b.a desc, encode(array_to_string(b.p, ' '))) as rank
  from best b left join inside i on i.lang = b.lang and i.p = b.p
  where longer is null or 100::hugeint * longer < 80::hugeint * b.a
)
select lang, rank, phrase, a, l, r, n, score from ranked join total using (lang) where rank <= 2000
"""


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from estrato.llm.resampling import resample

    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: crc32 goes byte by byte through a table of 256 remainders, which the first query makes.
OP12_SQL = r"""
with recursive bit8 as (
  select n::bigint as n, n::bigint as c, 0 as k from range(256) t(n)
  union all
  select n, case when c & 1 = 1 then xor(3988292384::bigint, c >> 1) else c >> 1 end, k + 1 from bit8 where k < 8
), tab as (
  select list(c order by n) as t from bit8 where k = 8
), texts as (
  select row_number() over () as r, doc_id, 's' as side, text from documents
  union all select row_number() over (), null, 't', text from benchmark
), words as (
  select r, side, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from texts
), feats as (
  select r, side, unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) as f from words
), each as (
  select r, side, f, count(*) as n from feats group by r, side, f
), hashed as (
  select f, xor(list_reduce([4294967295::bigint] || list_transform(range(0, len(h) // 2),
      lambda i: ((strpos('0123456789ABCDEF', h[2 * i + 1]) - 1) * 16 + strpos('0123456789ABCDEF', h[2 * i + 2]) - 1)::bigint),
    lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295::bigint) % 10000 as bucket
  from (select distinct f, hex(encode(f)) as h from each), tab
), counts as (
  select bucket, coalesce(sum(n) filter (where side = 's'), 0)::double as s, coalesce(sum(n) filter (where side = 't'), 0)::double as t
  from each join hashed using (f) group by bucket
), gains as (
  select bucket, floor(1000 * ln((t + 1) * (st + 10000) / ((s + 1) * (tt + 10000))))::bigint as g
  from counts, (select sum(s) as st, sum(t) as tt from counts)
), weighed as (
  select r, sum(n * g)::bigint as g, sum(n)::bigint as n from each join hashed using (f) join gains using (bucket)
  where side = 's' group by r
), scored as (
  select doc_id, len(w) as n_words, coalesce(n, 0)::bigint as n_features,
    coalesce(floor(g::double / n::double), 0)::bigint as weight,
    ('0x' || substr(sha256('7:' || coalesce(doc_id::varchar, '')), 1, 8))::bigint as h
  from words left join weighed using (r) where side = 's'
), noisy as (
  select *, weight + floor(-1000 * ln(-ln((h + 0.5::double) / 4294967296::double)))::bigint as score from scored
), ranked as (
  select *, case when n_words >= 20 then row_number() over (partition by n_words >= 20 order by score desc, doc_id) end as place,
    count(*) filter (where n_words >= 20) over () as total
  from noisy
)
select doc_id, n_features, weight, score, case when place <= 25 * total // 100 then place end as rank from ranked
"""


def op13_identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    from estrato.llm.identifiers import digest, identifiers

    return digest(identifiers(table(spark, sf_dir, "documents")).rows)


QUERIES: dict[str, tuple[Query, str | None]] = {
    "op1_quality": (op1_quality, None),
    "op2_mixing": (op2_mixing, OP2_SQL),
    "op3_toxicity": (op3_toxicity, None),
    "op4_lm_scores": (op4_lm_scores, None),
    "op5_token_counts": (op5_token_counts, None),
    "op6_decontamination": (op6_decontamination, None),
    "op7_substrings": (op7_substrings, None),
    "op8_packing": (op8_packing, None),
    "op9_simhash": (op9_simhash, None),
    "op10_embeddings": (op10_embeddings, None),
    "op11_phrases": (op11_phrases, OP11_SQL),
    "op12_resampling": (op12_resampling, OP12_SQL),
    "op13_identifiers": (op13_identifiers, None),
}
