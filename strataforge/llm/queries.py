"""The pN_ queries of the problems on training text, and their SQL where SQL can express them on whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataforge.functions.values import date_text, filled, is_true, norm_id
from strataforge.llm.bpe import encode_corpus
from strataforge.llm.leakage import leaked_spans
from strataforge.llm.spans import shared_spans
from strataforge.llm.survivor import microseconds, survivors
from strataforge.session import table

#: Fields of a vehicle record that its survivor takes one by one.
SURVIVOR_FIELDS = ["client_id", "fuel_type", "state_registered", "odometer_km", "lease_end_date", "vehicle_status"]


#: A trusted row's bits above an untrusted one's, and microseconds in which a vote halves: together they make precedence strict.
TRUSTED_BITS, STRICT_HALF_LIFE = 2**62, 1 / 2


def vehicle_survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vehicle_id, _batch_date and each field's surviving value, source row and votes."""
    rows = table(spark, sf_dir, "vehicles_ext").where("_load_type = 'full' and vehicle_id is not null")
    rows = rows.withColumn("vehicle_id", norm_id(F.col("vehicle_id")))
    kinds = dict(rows.dtypes)
    fields = {c: F.when(filled(F.col(c)), F.col(c)) if kinds[c] == "string" else F.col(c) for c in SURVIVOR_FIELDS}
    ambiguous = F.coalesce(F.col("_latest_resolution_status") == "ambiguous_same_timestamp", F.lit(False))
    return survivors(
        rows, ["vehicle_id", "_batch_date"], fields, trust=F.when(ambiguous, 0).otherwise(F.lit(TRUSTED_BITS)), recency=microseconds(F.col("updated_at")),
        row_id=F.col("staged_row_id"), half_life=STRICT_HALF_LIFE, votes=~is_true(F.col("_is_exact_duplicate")), at_least=2,
    )


def p5_survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The survivors: of each field the value and, beside it, the row it is from."""
    one = vehicle_survivors(spark, sf_dir)
    return one.select("vehicle_id", date_text(F.col("_batch_date")).alias("batch_date"), *[c for f in SURVIVOR_FIELDS for c in (F.col(f)["value"].alias(f), F.col(f)["row_id"].alias(f"{f}_row"))])


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = vehicle_survivors(spark, sf_dir)
    pairs = F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f)["row_id"].alias("staged_row_id")) for f in SURVIVOR_FIELDS])
    long = one.select("vehicle_id", date_text(F.col("_batch_date")).alias("batch_date"), F.explode(pairs).alias("p"))
    return long.select("vehicle_id", "batch_date", "p.field_name", "p.staged_row_id").where("staged_row_id is not null")


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_corpus(table(spark, sf_dir, "documents"))


def p9_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaked_spans(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p9_spans(spark, sf_dir).select("doc_id", "item_id").distinct()


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared_spans(table(spark, sf_dir, "documents"))


def p10_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each document: characters, and how many of them also stand elsewhere."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce(F.length("text"), F.lit(0)).alias("chars"))
    spans = p10_found(spark, sf_dir).groupBy("doc_id").agg(F.sum(F.col("span_end") - F.col("span_start")).alias("shared"), F.count(F.lit(1)).alias("spans"))
    return docs.join(spans, "doc_id", "left").select("doc_id", "chars", F.coalesce("shared", F.lit(0)).alias("shared_chars"), F.coalesce("spans", F.lit(0)).alias("n_spans"))


QUERIES = {"p5_found": p5_found, "p5_survivors": p5_survivors, "p8_ids": p8_ids, "p9_found": p9_found, "p9_spans": p9_spans, "p10_found": p10_found, "p10_share": p10_share}

_FIELD = """select upper(trim(vehicle_id)) vehicle_id, strftime(_batch_date, '%Y-%m-%d') batch_date, '{0}' field_name, staged_row_id, {0}::varchar val, updated_at u,
  coalesce(_latest_resolution_status = 'ambiguous_same_timestamp', false) a, coalesce(_is_exact_duplicate, false) x, {1} ok,
  count(*) over (partition by upper(trim(vehicle_id)), _batch_date) n from vehicles_ext where _load_type = 'full' and vehicle_id is not null"""
_FIELDS = " union all ".join(
    _FIELD.format(f, f"{f} is not null" if f in ("odometer_km", "lease_end_date") else f"coalesce(lower(trim({f})) not in ('', 'n/a', 'unknown', '-', 'tbc'), false)") for f in SURVIVOR_FIELDS
)
_P5 = f"""select vehicle_id, batch_date, field_name, staged_row_id, val from ({_FIELDS}) where n > 1 and ok and not x
  qualify row_number() over (partition by vehicle_id, batch_date, field_name order by a, u desc nulls last, staged_row_id desc) = 1"""
_WORDS = """with chars as (
    select {id} id, unnest(range(1, length({text}) + 1)) p, unnest(string_split({text}, '')) c from {table} where {text} <> ''
  ), marked as (
    select id, p, lower(c) c, regexp_full_match(lower(c), '[a-z0-9]') inside, lag(regexp_full_match(lower(c), '[a-z0-9]'), 1, false) over (partition by id order by p) before from chars
  ), numbered as (
    select id, p, c, inside, count(*) filter (inside and not before) over (partition by id order by p) k from marked
  ), words as (
    select id, k, min(p) - 1 a, max(p) z, string_agg(c, '' order by p) w from numbered where inside group by id, k
  )
  select id, k, a, lead(z, 9) over (partition by id order by k) z, string_agg(w, ' ') over (partition by id order by k rows between current row and 9 following) s from words
  qualify z is not null"""
# Every stretch of 200 characters once a document, whole, not by a hash.
_P10 = """with st as (
    select doc_id, p, text[p + 1:p + 200] s from (select doc_id, text, unnest(range(length(text) - 199)) p from documents where length(text) >= 200)
  ), marks as (
    select doc_id, p from (select doc_id, p, min(doc_id) over (partition by s) a, max(doc_id) over (partition by s) z from st) where a <> z
  ), runs as (
    select doc_id, p, count(*) filter (gap) over (partition by doc_id order by p) r
    from (select doc_id, p, coalesce(p > lag(p) over (partition by doc_id order by p) + 200, true) gap from marks)
  ), spans as (select doc_id, min(p) span_start, max(p) + 200 span_end from runs group by doc_id, r)
"""
SQL = {
    "p5_found": f"select vehicle_id, batch_date, field_name, staged_row_id from ({_P5})",
    "p5_survivors": "select vehicle_id, batch_date, "
    + ", ".join(f"max(val) filter (field_name = '{f}') {f}, max(staged_row_id) filter (field_name = '{f}') {f}_row" for f in SURVIVOR_FIELDS)
    + f" from ({_P5}) group by 1, 2",
    "p9_found": """with recursive d as (
    select doc_id, regexp_extract_all(lower(text), '[a-z0-9]+') w from documents where text is not null
  ), i as (
    select item_id, regexp_extract_all(lower(item_text), '[a-z0-9]+') w from eval_items where item_text is not null
  ), ds as (
    select doc_id, unnest([array_to_string(w[k:k + 9], ' ') for k in range(1, len(w) - 8)]) s from d where len(w) >= 10
  ), si as (
    select item_id, unnest([array_to_string(w[k:k + 9], ' ') for k in range(1, len(w) - 8)]) s from i where len(w) >= 10
  )
  select distinct doc_id, item_id from ds join si using (s)""",
    "p9_spans": f"""with d as ({_WORDS.format(id="doc_id", text="text", table="documents")}), i as ({_WORDS.format(id="item_id", text="item_text", table="eval_items")}),
  hits as (select distinct d.id doc_id, i.id item_id, d.k, d.a, d.z from d join i using (s)),
  runs as (
    select *, count(*) filter (gap) over (partition by doc_id, item_id order by k) r
    from (select *, coalesce(k > lag(k) over (partition by doc_id, item_id order by k) + 10, true) gap from hits)
  )
  select doc_id, item_id, min(a)::bigint span_start, max(z)::bigint span_end from runs group by doc_id, item_id, r""",
    "p10_found": _P10 + "select doc_id, span_start::bigint span_start, span_end::bigint span_end from spans",
    "p10_share": _P10 + """select d.doc_id, coalesce(length(text), 0)::int chars, coalesce(sum(span_end - span_start), 0)::bigint shared_chars, count(span_end) n_spans
  from documents d left join spans s on s.doc_id = d.doc_id group by d.doc_id, text""",
}
