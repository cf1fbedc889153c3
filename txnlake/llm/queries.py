"""One query for each operator: production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlake.llm import audit, chat, embeddings, importance, jaccard, language, mixing, passages, quality, secrets, templates, warc, wordpiece
from txnlake.llm.tables import load


def remainder(column: str, n: int) -> F.Column:
    return F.crc32(F.col(column).cast("string").cast("binary")) % n


def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; labels of the held-out quarter are never read."""
    docs = load(spark, sf_dir, "documents")
    labels = load(spark, sf_dir, "labels").where(remainder("doc_id", 4) != 2)
    scored = quality.score(docs.select("doc_id", "text"), quality.fit(docs, labels))
    return scored.select(
        "doc_id",
        F.coalesce(remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out"),
        F.col("quality_score").alias("score"),
        (F.col("quality_score") >= quality.KEEP_AT).cast("int").alias("predicted"),
    )


def jaccard_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingle sets of every document linked at 0.8 and more, with their components."""
    docs = load(spark, sf_dir, "documents")
    return jaccard.link_components(docs).select("doc_id", "n_shingles", "component_id")


def secret_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: base spans, and those that the Markov models add."""
    docs = load(spark, sf_dir, "documents")
    found = secrets.scan(docs.select("doc_id", "text"), secrets.fit(secrets.labelled(docs)))
    return found.select(
        "doc_id",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(secrets.spans("assign", "access", "hex").cast("binary"), 256).alias("base_sha256"),
        secrets.spans(*secrets.KINDS).alias("spans"),
        F.size("markov").cast("long").alias("n_markov"),
    )


def poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document repeated towards weights by the square root of its source's size."""
    docs = load(spark, sf_dir, "documents")
    return mixing.replicated(docs, mixing.target_rates(docs)).select("doc_id", "source", "text", "copies", "copy", "shuffle_key")


def benchmark_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold template windows of a benchmark item."""
    return templates.contaminated(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


def language_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; texts of the held-out third are never learned from."""
    docs = load(spark, sf_dir, "documents")
    profiles = language.learn(docs.where(remainder("doc_id", 3) != 1))
    return language.predict(docs.select("doc_id", "text"), profiles).select(
        "doc_id", F.coalesce(remainder("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score"
    )


def vector_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors of equal labels linked at a cosine of 0.93 and more."""
    return embeddings.link_vectors(load(spark, sf_dir, "embeddings"))


def page_captures(pages: DataFrame) -> DataFrame:
    """Web captures made from the pages: three of each.

    A full response at a time given by the id, a later revisit that carries the page's ETag (a
    mismatch where another page has the same URL), and an earlier revisit without validators.
    """
    headers = lambda *pairs: F.map_from_arrays(F.array(*[F.lit(k) for k, _ in pairs]), F.array(*[v.cast("string") for _, v in pairs]))
    etag, size = F.md5(F.col("html").cast("binary")), F.length("html")
    full = pages.select(
        (F.col("page_id") * 3).alias("record_id"), "url", F.col("page_id").alias("ts"), F.lit("response").alias("kind"),
        headers(("Content-Type", F.lit("text/html")), ("Content-Length", size), ("ETag", etag), ("Date", F.col("page_id"))).alias("headers"),
    )
    again = pages.select(
        (F.col("page_id") * 3 + 1).alias("record_id"), "url", (F.col("page_id") + 1000).alias("ts"), F.lit("revisit").alias("kind"),
        headers(("Content-Length", F.lit(0)), ("ETag", etag), ("Date", F.col("page_id") + 1000)).alias("headers"),
    )
    bare = pages.select(
        (F.col("page_id") * 3 + 2).alias("record_id"), "url", (F.col("page_id") - 1000).alias("ts"), F.lit("revisit").alias("kind"),
        headers(("Expires", F.col("page_id")), ("Date", F.col("page_id") - 1000)).alias("headers"),
    )
    return full.union(again).union(bare)


def revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revisits of all pages with the response that each stands for."""
    found = warc.resolve(page_captures(load(spark, sf_dir, "pages")))
    named = F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return found.withColumn("headers", F.array_join(named, "; "))


_HOST = r"regexp_replace(regexp_replace(lower(regexp_extract(rest, '^[^/?]*')), '^www\.', ''), ':(80|443)$', '')"
_PATH = r"regexp_replace(regexp_extract(rest, '^[^/?]*([^?]*)', 1), '/+$', '')"
_ASKED = r"array_to_string(list_sort(list_filter(string_split(regexp_extract(rest, '\?(.*)$', 1), '&'), lambda p: p <> '' and not regexp_matches(p, '^(utm_[a-z]+|ref|fbclid|gclid)='))), '&')"
REVISITS_SQL = f"""
with a as (
  select page_id, md5(html) as etag, length(html) as size,
    regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') as rest from pages
),
p as (select *, {_HOST} || {_PATH} || case when {_ASKED} <> '' then '?' || {_ASKED} else '' end as key from a),
asked as (
  select page_id * 3 + 1 as record_id, key, page_id + 1000 as ts, etag, null as expires, 0 as size from p
  union all select page_id * 3 + 2, key, page_id - 1000, null, page_id, null from p
),
ranked as (
  select q.*, f.page_id as found, f.etag as found_etag, f.size as found_size,
    row_number() over (partition by q.record_id order by f.page_id desc nulls last) as n
  from asked q left join p f on f.key = q.key and f.page_id <= q.ts
),
judged as (
  select *, case when found is null then 'none' when etag is null then 'unchecked' when etag = found_etag then 'etag' else 'mismatch' end as verdict from ranked where n = 1
)
select record_id, key as canonical_url, ts, found * 3 as response_id, found as response_ts, verdict,
  concat_ws('; ',
    case when verdict in ('etag', 'unchecked') then 'content-length=' || found_size when size is not null then 'content-length=' || size end,
    case when verdict in ('etag', 'unchecked') then 'content-type=text/html' end,
    'date=' || ts,
    case when etag is not null then 'etag=' || etag when verdict = 'unchecked' then 'etag=' || found_etag end,
    case when expires is not null then 'expires=' || expires end) as headers
from judged
"""


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word-piece tokens of every document."""
    return wordpiece.count_tokens(load(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_tokens")


def repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that share a passage of 50 words and more with another document."""
    found = passages.repeated_passages(load(spark, sf_dir, "documents"))
    spans = F.array_join(F.transform("spans", lambda x: F.concat_ws(":", x["start"], x["end"])), ",")
    return found.select("doc_id", spans.alias("spans"), "n_words", "with_doc")


def filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove from each language, in every order of applying them."""
    counts = audit.failure_counts(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))
    return audit.audit(counts)


def importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, score and rank of every document in a sample that looks like the benchmark."""
    drawn = importance.resample(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


IMPORTANCE_SQL = r"""
with crc as (
  select list(list_reduce(list_prepend(b, range(8)), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by b) as t
  from range(256) r(b)
),
texts as (
  select row_number() over () as id, own, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
  from (select true as own, doc_id, text from documents union all select false, null, text from benchmark)
),
features as (
  select id, own, unnest(list_concat(words, list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]))) as f from texts
),
counted as (select id, own, f, count(*) as n from features group by all),
bytes as (
  select f, list_transform(range(len(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::bigint) as b from (select distinct f, hex(f) as h from counted)
),
placed as (
  select f, xor(list_reduce(list_prepend(4294967295::bigint, b), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 10000 as bucket
  from bytes, crc
),
found as (select id, own, bucket, sum(n)::bigint as n from counted join placed using (f) group by all),
totals as (
  select bucket, coalesce(sum(n) filter (where own), 0) as s, coalesce(sum(n) filter (where not own), 0) as t from found group by bucket
),
sums as (select sum(s)::double as all_s, sum(t)::double as all_t from totals),
gains as (select bucket, floor(1000 * ln((t + 1.0::double) * (all_s + 10000) / ((s + 1.0::double) * (all_t + 10000))))::bigint as gain from totals, sums),
sized as (select id, sum(n)::bigint as n_features, floor(sum(n * gain)::double / sum(n))::bigint as weight from found join gains using (bucket) where own group by id),
scored as (
  select texts.id, doc_id, len(words) as n_words, coalesce(n_features, 0) as n_features, coalesce(weight, 0) as weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || coalesce(doc_id::varchar, 'null')), 1, 8))::bigint + 0.5::double) / 4294967296)))::bigint as score
  from texts left join sized on sized.id = texts.id where own
),
places as (
  select id, row_number() over (order by score desc, doc_id nulls last, n_words, n_features, weight) as place, count(*) over () * 25 // 100 as drawn
  from scored where n_words >= 20
)
select doc_id, n_features, weight, score, case when place <= drawn then place end as rank
from scored left join places on places.id = scored.id
"""

#: A conversation of the query's own, whose texts are made of control strings.
CONTROL_TURNS = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


def chat_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digests of all conversations, read back from their formatted examples."""
    talks = load(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame(CONTROL_TURNS, "conv_id long, turn long, role string, text string")
    return chat.read_back(chat.examples(talks.unionByName(more)))


CHAT_EXAMPLES_SQL = r"""
with asked as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as body from conversations
  union all select -1, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'
),
sized as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, body) as place,
    row_number() over (partition by conv_id order by turn desc nulls last, role desc, body desc) as back,
    length(regexp_replace(body, '(<\\*(s>|/s>|<SYS>>|</SYS>>)|\[\\*(INST\]|/INST\]))', '\1.', 'g'))
    + case role when 'system' then 15 when 'user' then 15 when 'assistant' then 4
      else 11 + length(regexp_replace(role, '(<\\*(s>|/s>|<SYS>>|</SYS>>)|\[\\*(INST\]|/INST\]))', '\1.', 'g')) end as size
  from asked
),
added as (select *, sum(size) over (partition by conv_id order by place) as upto from sized)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || body || chr(10), '' order by place)) as turns_sha256,
  coalesce(sum(length(body)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(body, '' order by place) filter (where role = 'assistant'), '')) as loss_sha256,
  sum(case when role = 'assistant' or back = 1 then upto else 0 end)::bigint as formatted_chars,
  count(*) filter (where role = 'assistant' or back = 1) as n_examples
from added group by conv_id
"""


FILTER_AUDIT_SQL = """
with recursive marks as (
  select doc_id, max(case when quality = 1 then 1 else 0 end) as good, max(case when toxic = 1 then 1 else 0 end) as toxic
  from labels where doc_id is not null group by doc_id
),
texts as (
  select doc_id, coalesce(lang, '') as part, coalesce(text, '') as body,
    list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') as words from documents
),
firsts as (select body, min(doc_id) as least from texts group by body),
judged as (
  select part, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic,
    (case when len(words) < 200 then 'A' else '' end)
    || (case when 100 * len(list_distinct(words)) < 50 * len(words) then 'B' else '' end)
    || (case when 100 * length(regexp_replace(texts.body, '[^A-Z]', '', 'g')) > 3 * length(texts.body) then 'C' else '' end)
    || (case when regexp_matches(texts.body, '[#$%&*|]') then 'D' else '' end)
    || (case when texts.doc_id > least then 'E' else '' end) as failed
  from texts join firsts on firsts.body = texts.body left join marks on marks.doc_id = texts.doc_id
),
kinds as (select part, failed, count(*) as n, sum(good) as good, sum(toxic) as toxic from judged group by part, failed),
orders as (
  select '' as filter_order
  union all
  select filter_order || f from orders, (select unnest(['A', 'B', 'C', 'D', 'E']) as f) as letters where not contains(filter_order, f)
),
steps as (
  select filter_order, step, substr(filter_order, step, 1) as f, substr(filter_order, 1, step - 1) as earlier
  from orders, (select unnest(range(1, 6))::int as step) as numbers where length(filter_order) = 5
),
met as (
  select part, filter_order, step, f, failed, n, good, toxic, contains(failed, f) as fails,
    earlier <> '' and regexp_matches(failed, '[' || earlier || '0]') as gone from kinds, steps
),
told as (
  select part, filter_order, step, f,
    sum(case when not gone and not fails then n else 0 end)::bigint as kept,
    sum(case when not gone and fails then n else 0 end)::bigint as removed,
    sum(case when gone and fails then n else 0 end)::bigint as redundant,
    sum(case when failed = f then n else 0 end)::bigint as unique_fails,
    sum(case when not gone and fails then good else 0 end)::bigint as good_lost,
    sum(case when not gone and fails then toxic else 0 end)::bigint as toxic_lost
  from met group by part, filter_order, step, f
)
select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) over (partition by part, f))::bigint as shapley from told
"""

POISSON_MIX_SQL = f"""
with sizes as (select source, count(*) as n from documents group by source),
totals as (select sum(n) as rows_all, sum(pow(n, {mixing.POWER})) as weight_all from sizes),
rates as (select source, rows_all * pow(n, {mixing.POWER}) / weight_all / n as rate from sizes, totals),
laws as (
  select source, sum(exp(k * ln(rate) - rate - lgamma(k + 1))) over (partition by source order by k) as cdf
  from rates, range(0, 400) as t(k)
),
draws as (
  select *, (('0x' || substr(md5('{mixing.SEED}:' || coalesce(doc_id::varchar, 'null') || ':1'), 1, 12))::bigint + 0.5) / pow(2, 48) as u
  from documents
),
counted as (
  select d.doc_id, d.source, d.text, (select count(*) from laws where laws.source is not distinct from d.source and cdf < u)::int as copies
  from draws d
)
select doc_id, source, text, copies, copy::int as copy, md5('order{mixing.SEED}:' || coalesce(doc_id::varchar, 'null') || ':' || copy) as shuffle_key
from counted, unnest(range(1, copies + 1)) as c(copy)
"""


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_revisits": revisits,
        "op2_token_counts": token_counts,
        "op3_secret_spans": secret_spans,
        "op4_poisson_mix": poisson_mix,
        "op5_jaccard_join": jaccard_components,
        "op6_language_profiles": language_profiles,
        "op7_embedding_join": vector_components,
        "op8_repeated_passages": repeated_passages,
        "op9_benchmark_templates": benchmark_templates,
        "op10_quality": quality_scores,
        "op11_filter_audit": filter_audit,
        "op12_importance_resampling": importance_resampling,
        "op13_chat_examples": chat_examples,
    }


def all_oracles() -> dict[str, str]:
    return {"op1_revisits": REVISITS_SQL, "op4_poisson_mix": POISSON_MIX_SQL, "op11_filter_audit": FILTER_AUDIT_SQL, "op12_importance_resampling": IMPORTANCE_SQL, "op13_chat_examples": CHAT_EXAMPLES_SQL}
