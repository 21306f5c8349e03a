"""Checks, data-quality rules, masking, certification, lineage, reconciliation, profiles and run monitoring."""

from __future__ import annotations

import json
from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataforge.operators.features import RULES as FEATURE_WEIGHTS
from strataforge.operators.sliced import neighbours, with_slices
from strataforge.operators.staging import may_be_merged
from strataforge.schema import infer_type_by_value

# What may be done about a broken rule, and how grave a difference is.
ACTIONS = ("log", "warn", "quarantine", "mask", "fail_pipeline", "require_approval")
BOOLEAN_TOKENS = ("true", "false", "yes", "no", "y", "n", "1", "0")

#: How an actual value is compared with the expected one.
OPERATORS = {"=": lambda a, e: a == e, ">": lambda a, e: a > e, ">=": lambda a, e: a >= e, "<": lambda a, e: a < e, "<=": lambda a, e: a <= e, "<>": lambda a, e: a != e}


@dataclass(frozen=True)
class Check:
    """A number to be measured and what it must be: ``measure`` is an aggregate, ``expected`` a number or another aggregate."""

    test_id: str
    name: str
    measure: Column
    expected: int | Column = 0
    op: str = "="
    notes: str = ""


def run_checks(df: DataFrame, checks: Sequence[Check], tested_at: str | None = None) -> DataFrame:
    """A row for each check, all from one pass over df: test_id, test_name, actual_value, expected_value, test_status (PASS or FAIL),
    test_notes, tested_at. A measure that is null counts as 0."""
    number = lambda c: F.coalesce(c.cast("long"), F.lit(0).cast("long"))
    one = df.agg(*[number(c.measure).alias(f"a{i}") for i, c in enumerate(checks)], *[number(c.expected if isinstance(c.expected, Column) else F.lit(c.expected)).alias(f"e{i}") for i, c in enumerate(checks)])
    rows = [
        F.struct(
            F.lit(c.test_id).alias("test_id"), F.lit(c.name).alias("test_name"), F.col(f"a{i}").cast("string").alias("actual_value"), F.concat(F.lit(f"{c.op} "), F.col(f"e{i}").cast("string")).alias("expected_value"),
            F.when(OPERATORS[c.op](F.col(f"a{i}"), F.col(f"e{i}")), "PASS").otherwise("FAIL").alias("test_status"), F.lit(c.notes).alias("test_notes"), F.lit(tested_at).cast("timestamp_ntz").alias("tested_at"),
        )
        for i, c in enumerate(checks)
    ]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def check_suite(results: Sequence[DataFrame], total_id: str | None = None) -> DataFrame:
    """Results put together; ``total_id`` adds a check that none of them failed."""
    all_ = reduce(DataFrame.unionByName, results)
    if total_id is None:
        return all_
    return all_.unionByName(run_checks(all_, [Check(total_id, "no check failed", F.count_if(F.col("test_status") != "PASS"))]))


def _n(predicate: str | Column) -> Column:
    return F.count_if(F.expr(predicate) if isinstance(predicate, str) else predicate)


def scd2_invariants(dim: DataFrame, key: str, surrogate_key: str) -> DataFrame:
    """What must hold for any dimension with history: one current row a key, unique surrogates, ordered periods, no overlap.

    One pass by key and one by surrogate key; keys with very many versions are cut into slices."""
    sliced, cut = with_slices(dim, key, ["effective_from", surrogate_key])
    beside = neighbours(sliced, key, ["effective_from", surrogate_key], cut, after="_after", columns=["effective_from"])
    current = F.coalesce(F.col("is_current"), F.lit(False))
    per_key = beside.groupBy(key).agg(
        _n(current).alias("current"), _n("effective_to < effective_from").alias("ends_early"), _n(current & (F.col("effective_to") < F.lit("9999-12-31").cast("timestamp_ntz"))).alias("closed"),
        _n("deleted_flag and is_current").alias("deleted"), _n("_after.effective_from < effective_to").alias("overlap"),
    )
    by_key = run_checks(per_key, [
        Check("SCD001", "one current row a key", _n("current > 1")), Check("SCD003", "periods don't end before they begin", F.sum("ends_early")), Check("SCD004", "current rows are open", F.sum("closed")),
        Check("SCD005", "deleted rows aren't current", F.sum("deleted")), Check("SCD006", "periods of a key don't overlap", F.sum("overlap")),
    ])
    return by_key.unionByName(run_checks(dim.groupBy(surrogate_key).agg(F.count(F.lit(1)).alias("n")), [Check("SCD002", "surrogate keys are unique", _n("n > 1"))]))


def load_counts(dim: DataFrame, prefix: str, current: int, closed: int, deleted: int, tested_at: str | None = None) -> DataFrame:
    """A dimension's rows after a load against the numbers expected of it."""
    return run_checks(dim, [
        Check(f"{prefix}_CURRENT", "current rows", _n("is_current"), current), Check(f"{prefix}_CLOSED", "closed rows of changed records", _n("not is_current and not deleted_flag"), closed),
        Check(f"{prefix}_DELETED", "soft-deleted rows", _n("deleted_flag"), deleted),
    ], tested_at)


def dimension_tests(dim: DataFrame, key: str, latest: DataFrame, before: DataFrame, *, deleted: int = 0, tested_at: str | None = None) -> DataFrame:
    """Ten tests of a dimension against the two full extracts it was last merged from (staged rows), from one grouping by key.

    Expected counts come from the extracts: as many current rows as the latest has eligible keys, as many closed ones as
    hashes changed, and ``deleted`` soft deletes.
    """
    hash_of = lambda df: F.when(may_be_merged(), F.col("_record_hash"))
    no, none = F.lit(0).cast("long"), F.lit(None).cast("string")

    def facts(df: DataFrame, **given: Column) -> DataFrame:
        names = {"current": no, "closed": no, "gone": no, "bad": no, "unresolved": no, "h": none, "h1": none, "h2": none}
        return df.select(F.col(key).cast("string").alias("k"), *[given.get(n, c).alias(n) for n, c in names.items()])

    one = lambda c: F.coalesce(F.expr(c).cast("long"), no)
    all_ = facts(
        dim, current=one("is_current"), closed=one("not is_current and not deleted_flag"), gone=one("deleted_flag"), h=F.when(F.col("is_current"), F.col("source_record_hash")),
        bad=one("effective_from is null or effective_to is null or effective_from >= effective_to"),
    )
    unresolved = one("_latest_resolution_status = 'ambiguous_same_timestamp'")
    all_ = all_.unionByName(facts(latest, h2=hash_of(latest), unresolved=unresolved)).unionByName(facts(before, h1=hash_of(before), unresolved=unresolved))
    per_key = all_.where("k is not null").groupBy("k").agg(*[F.sum(c).alias(c) for c in ("current", "closed", "gone", "bad", "unresolved")], *[F.max(c).alias(c) for c in ("h", "h1", "h2")])
    changed = F.col("h1").isNotNull() & F.col("h2").isNotNull() & (F.col("h1") != F.col("h2"))
    results = run_checks(per_key, [
        Check("UT001", "a current row for each eligible key of the latest extract", F.sum("current"), _n("h2 is not null")),
        Check("UT002", "a closed row for each changed hash", F.sum("closed"), _n(changed)),
        Check("UT003", "soft deletes", F.sum("gone"), deleted),
        Check("UT004", "one current row a key", _n("current > 1")),
        Check("UT005", "periods are ordered and whole", F.sum("bad")),
        Check("UT006", "current rows have the latest hash", _n("h is not null and h2 is not null and h <> h2")),
        Check("UT007", "hashes did change between the extracts", _n(changed), 0, ">"),
        Check("UT008", "a changed key has one closed row", _n(changed & (F.col("closed") != 1))),
        Check("UT009", "ambiguous keys aren't current", _n("unresolved > 0 and current > 0 and h2 is null and h1 is null")),
    ], tested_at)
    return check_suite([results], "UT010")


def feature_tests(feature: DataFrame, transactions: DataFrame, vehicles: DataFrame, clients: DataFrame, *, batch_date: str | None = None, key: str = "fuel_transaction_id", tested_at: str | None = None) -> DataFrame:
    """Twelve tests of a scored feature against its transactions and dimensions, from one grouping by transaction.

    Every transaction once and nothing beside them, scores in range that fit flags and codes, keys looked up where they
    exist, lineage there, the batch date asked for (any, if None), and something found at all.
    """
    flags = dict((f, w) for f, w, _ in FEATURE_WEIGHTS)
    total = F.least(F.lit(100), reduce(lambda a, b: a + b, [F.when(F.coalesce(F.col(f), F.lit(False)), w).otherwise(0) for f, w in flags.items()]))
    codes = F.nullif(F.trim("anomaly_reason_codes"), F.lit(""))
    score = F.col("fuel_anomaly_score")
    known = feature
    for dim, name in ((vehicles, "vehicle"), (clients, "client")):
        keys = dim.where("is_current").select(F.col(f"{name}_id").alias(f"_{name}")).distinct()
        known = known.join(keys, F.col(f"{name}_id") == F.col(f"_{name}"), "left")
    unresolved = (F.col("_vehicle").isNotNull() & F.col("vehicle_sk").isNull()) | (F.col("_client").isNotNull() & F.col("client_sk").isNull())
    lineage_gap = F.col("feature_version").isNull() | F.col("scored_at").isNull() | F.col("batch_date").isNull() | F.col("source_record_hash").isNull()
    wrong_date = (F.col("batch_date") != F.lit(batch_date).cast("date")) if batch_date else F.lit(False)
    marks = {
        "scored": F.lit(True), "asked": F.lit(False), "out_of_range": score.isNull() | ~score.between(0, 100), "no_codes": (score > 0) & codes.isNull(), "idle_codes": (score == 0) & codes.isNotNull(),
        "arithmetic": score != total, "unresolved": unresolved, "lineage": lineage_gap, "dated": wrong_date, "found": score > 0,
    }
    as_number = lambda c: F.coalesce(c.cast("int"), F.lit(0))
    rows = known.select(F.col(key).cast("string").alias("k"), *[as_number(c).alias(n) for n, c in marks.items()])
    asked = transactions.select(F.col(key).cast("string").alias("k"), *[F.lit(int(n == "asked")).alias(n) for n in marks])
    per_key = rows.unionByName(asked).groupBy("k").agg(*[F.sum(n).alias(n) for n in marks])
    results = run_checks(per_key, [
        Check("UAT001", "as many scores as transactions", F.sum("scored"), F.sum("asked")), Check("UAT002", "a transaction is scored once", _n("scored > 1")), Check("UAT003", "every transaction is scored", _n("asked > 0 and scored = 0")),
        Check("UAT004", "scores are 0 to 100", F.sum("out_of_range")), Check("UAT005", "a score has codes", F.sum("no_codes")), Check("UAT006", "no score has no codes", F.sum("idle_codes")),
        Check("UAT007", "a score is the capped sum of its flags' weights", F.sum("arithmetic")), Check("UAT008", "keys are looked up where they exist", F.sum("unresolved")), Check("UAT009", "lineage is there", F.sum("lineage")),
        Check("UAT010", "the batch date is the one asked for", F.sum("dated")), Check("UAT011", "something is found", F.sum("found"), 1, ">="),
    ], tested_at)
    return check_suite([results], "UAT012")


# Predicates a valid row fulfils. Null values are valid except for not_null, as other rules are about values that are there.
def not_null(c: str) -> Column:
    return F.col(c).isNotNull()


def non_negative(c: str) -> Column:
    return F.col(c).isNull() | (F.col(c) >= 0)


def in_range(c: str, low: float, high: float) -> Column:
    return F.col(c).isNull() | F.col(c).between(low, high)


def non_negative_text(c: str) -> Column:
    """Not below zero, given as a number or as text; text that is no number is another rule's."""
    return F.coalesce(F.col(c).cast("string").try_cast("decimal(38,6)") >= 0, F.lit(True))


def parses_as(c: str, kind: str) -> Column:
    return F.col(c).isNull() | F.col(c).cast("string").try_cast(kind).isNotNull()


def boolean_token(c: str) -> Column:
    return F.col(c).isNull() | F.lower(F.trim(F.col(c).cast("string"))).isin(*BOOLEAN_TOKENS)


# The catalogue of quality rules. ``columns``: the rule is for tables that have one of them (by whole name or ending);
# none: for all. ``key`` and ``times`` are the contract's.
CATALOGUE = [
    {"rule_name": "key_filled", "kind": "required", "columns": ["key"], "action": "fail_pipeline"},
    {"rule_name": "version_unique", "kind": "unique", "columns": ["key", "effective_at", "updated_at", "_record_hash"], "action": "log"},
    {"rule_name": "times_filled", "kind": "required", "columns": ["effective_at", "updated_at"], "mutable": True, "action": "fail_pipeline"},
    {"rule_name": "latest_unambiguous", "kind": "resolved", "columns": ["_latest_resolution_status"], "mutable": True, "action": "quarantine"},
    {"rule_name": "client_exists", "kind": "reference", "columns": ["client_id"], "action": "quarantine"},
    {"rule_name": "vehicle_exists", "kind": "reference", "columns": ["vehicle_id"], "action": "quarantine"},
    {"rule_name": "vendor_exists", "kind": "reference", "columns": ["vendor_id"], "action": "quarantine"},
    {"rule_name": "fuel_card_exists", "kind": "reference", "columns": ["fuel_card_id"], "action": "quarantine"},
    {"rule_name": "dates_parse", "kind": "time", "endings": ["_date", "_datetime", "_at"], "action": "quarantine"},
    {"rule_name": "money_not_negative", "kind": "non_negative", "endings": ["_amount"], "action": "quarantine"},
    {"rule_name": "percentage_in_range", "kind": "percentage", "endings": ["_pct"], "action": "quarantine"},
    {"rule_name": "flags_parse", "kind": "boolean", "endings": ["_flag"], "action": "quarantine"},
]


def catalogue_predicates(df: DataFrame, key: str, *, mutable: bool = True, parents: Mapping[str, DataFrame] | None = None, rules: Sequence[Mapping[str, Any]] = CATALOGUE) -> tuple[DataFrame, dict[str, Column]]:
    """df with the marks some rules need (columns that begin with _q) and, by name, the predicates of the rules that apply to it.

    ``parents``: by foreign key column, the parent table, of whose rows the current ones count (all, if it has no
    is_current) and whose column has the same name. Columns that begin with an underscore aren't business columns, and the
    table's own key is no foreign key. Duplicate and missing keys are found by aggregates of keys joined back, so no
    task sees all rows of a key at once.
    """
    business, predicates, out = [c for c in df.columns if not c.startswith("_")], {}, df
    for i, rule in enumerate(rules):
        kind = rule["kind"]
        named = [key if c == "key" else c for c in rule.get("columns", [])]
        columns = [c for c in named if c in df.columns] if named else [c for c in business if any(c.endswith(e) for e in rule["endings"])]
        if not columns or (rule.get("mutable") and not mutable) or (kind == "unique" and len(columns) < len(named)):
            continue
        if kind == "required":
            test = [not_null(c) & (F.trim(F.col(c).cast("string")) != "") for c in columns]
        elif kind == "unique":
            repeated = df.groupBy(*[F.col(c).alias(f"_q{i}{n}") for n, c in enumerate(columns)]).agg(F.count(F.lit(1)).alias(f"_q{i}")).where(F.col(f"_q{i}") > 1)
            same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_q{i}{n}")) for n, c in enumerate(columns)])
            out = out.join(repeated, same, "left").drop(*[f"_q{i}{n}" for n in range(len(columns))])
            test = [F.col(f"_q{i}").isNull()]
        elif kind == "resolved":
            test = [F.coalesce(F.col(columns[0]) != "ambiguous_same_timestamp", F.lit(True))]
        elif kind == "reference":
            c = columns[0]
            if c == key or c not in (parents or {}):
                continue
            parent = parents[c].where("is_current") if "is_current" in parents[c].columns else parents[c]
            out = out.join(parent.select(F.col(c).alias(f"_q{i}")).distinct(), F.col(c) == F.col(f"_q{i}"), "left")
            test = [F.col(c).isNull() | F.col(f"_q{i}").isNotNull()]
        else:
            valid = {"time": lambda c: parses_as(c, "timestamp_ntz"), "non_negative": non_negative_text, "percentage": lambda c: in_range(c, 0, 100), "boolean": boolean_token}[kind]
            test = [valid(c) for c in columns]
        predicates[rule["rule_name"]] = reduce(and_, test)
    return out, predicates


def load_rules(text: str) -> list[dict[str, Any]]:
    """Governance rules from JSON, or from the plain list of named values that YAML seeds have, in the form enforce takes.

    A rule without an enforcement_action warns, or stops the pipeline if its severity is critical.
    """
    if text.lstrip().startswith(("{", "[")):
        read = json.loads(text)
        rules = read["governance_rules"] if isinstance(read, dict) else read
    else:
        rules = []
        for line in text.splitlines():
            body = line.strip()
            if body.startswith("#") or not body or body.endswith(":"):
                continue
            if body.startswith("- "):
                rules.append({})
                body = body[2:]
            name, _, value = body.partition(":")
            rules[-1][name.strip()] = {"true": True, "false": False}.get(value.strip().lower(), value.strip().strip("'\""))
    return [{"enforcement_action": "fail_pipeline" if r.get("severity") == "critical" else "warn", **r} for r in rules]


def run_rules(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """rule_name, checked_count, failed_count of all rules in a single pass; a predicate that is null fails."""
    failed = [F.count_if(~F.coalesce(p, F.lit(False))).alias(n) for n, p in rules.items()]
    one = df.agg(F.count(F.lit(1)).alias("_all"), *failed)
    rows = F.explode(F.array(*[F.struct(F.lit(n).alias("rule_name"), F.col("_all").alias("checked_count"), F.col(n).alias("failed_count")) for n in rules]))
    return one.select(rows.alias("r")).select("r.*")


def set_status(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """_dq_status passed or failed, and _dq_failures: the names of the rules a row breaks."""
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(p, F.lit(False)), F.lit(n)) for n, p in rules.items()]))
    marked = df.withColumn("_dq_failures", F.concat_ws(",", broken))
    return marked.withColumn("_dq_status", F.when(F.col("_dq_failures") == "", "passed").otherwise("failed"))


class ApprovalRequired(ValueError):
    """A rule is broken that somebody must approve before the rows may be used."""


def enforce(df: DataFrame, rules: Sequence[Mapping[str, Any]], approved: Collection[str] = ()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Kept rows, quarantined rows and the result of every enabled rule, by each rule's enforcement_action.

    fail_pipeline raises if its rule is broken; require_approval raises ApprovalRequired unless the rule's name is among those
    approved; quarantine moves rows; mask blanks the rule's column in the rows that break it; log and warn only report. All
    rules are counted in one pass, which runs here; a few numbers a rule.
    """
    enabled = [r for r in rules if r.get("enabled_flag", True)]
    for r in enabled:
        if r["enforcement_action"] not in ACTIONS:
            raise ValueError(f"Unknown enforcement_action: {r['enforcement_action']}")
    predicates = {r["rule_name"]: F.expr(r["rule_expression"]) for r in enabled}
    if not predicates:
        return df, df.limit(0), df.sparkSession.createDataFrame([], "rule_name string, checked_count bigint, failed_count bigint")
    counted = run_rules(df, predicates)
    rows = counted.collect()
    results = df.sparkSession.createDataFrame(rows, counted.schema)
    action = {r["rule_name"]: r["enforcement_action"] for r in enabled}
    broken = sorted(r.rule_name for r in rows if r.failed_count)
    stops = [n for n in broken if action[n] == "fail_pipeline"]
    if stops:
        raise ValueError("; ".join(f"{n}: fail_pipeline" for n in stops))
    waits = [n for n in broken if action[n] == "require_approval" and n not in approved]
    if waits:
        raise ApprovalRequired("; ".join(f"{n}: require_approval" for n in waits))
    quarantine = [predicates[n] for n, a in action.items() if a == "quarantine"]
    ok = reduce(lambda a, b: a & b, [F.coalesce(p, F.lit(False)) for p in quarantine], F.lit(True))
    kept, moved = df.where(ok), df.where(~ok)
    for r in enabled:
        if r["enforcement_action"] == "mask":
            c = r["source_column"]
            kept = kept.withColumn(c, F.when(F.coalesce(predicates[r["rule_name"]], F.lit(False)), F.col(c)))
    return kept, moved, results


def mask_column(c: Column, action: str, salt: str = "") -> Column:
    """mask: letters and digits blanked, shape kept; tokenize: a salted hash; redact: one fixed text; partial: all but the last four."""
    text = c.cast("string")
    if action == "mask":
        return F.mask(text)
    if action == "tokenize":
        return F.sha2(F.concat(F.lit(salt), text), 256)
    if action == "redact":
        return F.when(c.isNotNull(), "***")
    if action == "partial":
        return F.concat(F.repeat(F.lit("*"), F.greatest(F.length(text) - 4, F.lit(0))), F.right(text, F.lit(4)))
    raise ValueError(f"Unknown masking action: {action}")


def mask_pii(df: DataFrame, actions: Mapping[str, str], salt: str = "") -> DataFrame:
    return df.withColumns({c: mask_column(F.col(c), a, salt) for c, a in actions.items()})


def certify(checks: DataFrame, critical: Sequence[str] = ()) -> DataFrame:
    """One row: how many checks ran and failed, and whether the output is certified - no critical check (all, if none is named)
    failed and at least one ran."""
    counts = F.col("test_id").isin(*critical) if critical else F.lit(True)
    return checks.agg(
        F.count(F.lit(1)).alias("checks"), F.count_if(F.col("test_status") == "FAIL").alias("failed"),
        ((F.count_if(counts) > 0) & (F.count_if(counts & (F.col("test_status") != "PASS")) == 0)).alias("certified"),
    )


def lineage(mappings: DataFrame, *, run_id: str, code_version: str = "", model_version: str = "", approval_id: str = "") -> DataFrame:
    """A row for each mapped column: where it comes from, where it goes, by which rule, run, code and model."""
    cols = ["source_system", "source_object", "source_column", "target_platform", "target_object", "target_column", "transformation_rule"]
    have = set(mappings.columns)
    return mappings.select(*[(F.col(c) if c in have else F.lit(None).cast("string")).alias(c) for c in cols], F.lit(code_version).alias("generated_code_version"), F.lit(run_id).alias("pipeline_run_id"), F.lit(model_version).alias("model_version"), F.lit(approval_id).alias("approval_id"))


def reconcile_schemas(model: DataFrame, framework: DataFrame, platform: DataFrame) -> DataFrame:
    """Differences between three column inventories (object_name, column_name, data_type, nullable_flag, primary_key_flag,
    classification, rule): check_type, object_name, column_name, the three values and a severity.

    Names compare upper-cased; types without blanks. A row for each difference; none where all agree.
    """

    def inventory(df: DataFrame, side: str) -> DataFrame:
        have = set(df.columns)
        pick = lambda c: F.col(c).cast("string") if c in have else F.lit(None).cast("string")
        facts = F.struct(F.upper(F.regexp_replace(pick("data_type"), r"\s", "")).alias("data_type"), F.lower(pick("nullable_flag")).alias("nullable"), F.lower(pick("primary_key_flag")).alias("pk"), F.lower(pick("classification")).alias("classification"), pick("mapping").alias("mapping"), pick("rule").alias("rule"))
        return df.groupBy(F.upper("object_name").alias("object_name"), F.upper("column_name").alias("column_name")).agg(F.max(facts).alias(side))

    both = inventory(model, "m").join(inventory(framework, "f"), ["object_name", "column_name"], "full_outer").join(inventory(platform, "p"), ["object_name", "column_name"], "full_outer")
    objects = [d.select(F.upper("object_name").alias("object_name")).distinct().withColumn(f"_{s}", F.lit(True)) for s, d in (("mo", model), ("fo", framework), ("po", platform))]
    for o in objects:
        both = both.join(o, "object_name", "left")
    m, f, p = (F.col(x).isNotNull() for x in "mfp")
    mo, po = F.col("_mo").isNotNull(), F.col("_po").isNotNull()
    yes = lambda c: F.coalesce(F.col(c).isin("true", "y", "yes", "1"), F.lit(False))
    pii = F.coalesce(F.col("m.classification").contains("pii"), F.lit(False))

    def row(kind: str, when: Column, severity: str, fact: str | None = None) -> Column:
        values = [F.col(f"{s}.{fact}") if fact else F.when(F.col(s).isNotNull(), "present") for s in "mfp"]
        return F.when(when, F.struct(F.lit(kind).alias("check_type"), values[0].alias("model_value"), values[1].alias("framework_value"), values[2].alias("discovered_value"), F.lit(severity).alias("severity")))

    found = F.array_compact(F.array(
        row("object_missing", m & ~po, "Critical"), row("object_extra", p & ~mo & ~F.coalesce("_fo", F.lit(False)), "Medium"),
        row("column_missing", m & ~p & po, "High"), row("column_extra", p & ~m & mo, "Medium"),
        row("data_type_mismatch", m & p & ~F.col("m.data_type").eqNullSafe(F.col("p.data_type")), "High", "data_type"),
        row("nullability_mismatch", m & p & (F.col("m.nullable") != F.col("p.nullable")), "Medium", "nullable"),
        row("primary_key_mismatch", m & f & (yes("m.pk") != yes("f.pk")), "High", "pk"),
        row("mapping_gap", m & (~f | F.col("f.mapping").isNull()), "High", "mapping"),
        row("transformation_gap", f & F.col("f.mapping").isNotNull() & F.col("f.rule").isNull(), "Medium", "rule"),
        row("governance_gap", m & pii & F.coalesce(~F.col("f.rule").contains("mask"), F.lit(True)), "Critical", "classification"),
        row("dq_gap", m & yes("m.pk") & F.coalesce(~F.col("f.rule").contains("not_null"), F.lit(True)), "Medium", "rule"),
        row("lineage_gap", p & f & F.col("f.mapping").isNull(), "Low", "mapping"),
    ))
    return both.select("object_name", "column_name", F.explode(found).alias("r")).select("object_name", "column_name", "r.*")


def profile(df: DataFrame) -> DataFrame:
    """column_name, data_type, rows, nulls, approximate distinct, min, max and the type the values suggest; one pass."""
    simple = [(c, t) for c, t in df.dtypes if not t.startswith(("array", "map", "struct"))]
    aggs = []
    for i, (c, _) in enumerate(simple):
        col = F.col(f"`{c}`")
        kind = infer_type_by_value(col.cast("string"))
        aggs += [
            F.count(col).alias(f"n{i}"), F.approx_count_distinct(col).alias(f"d{i}"), F.min(col).cast("string").alias(f"a{i}"), F.max(col).cast("string").alias(f"z{i}"),
            F.count_if(col.isNotNull() & (kind == "integer")).alias(f"i{i}"), F.count_if(col.isNotNull() & (kind == "decimal")).alias(f"f{i}"),
        ]
    one = df.agg(F.count(F.lit(1)).alias("rows"), *aggs)
    rows = [
        F.struct(
            F.lit(c).alias("column_name"), F.lit(t).alias("data_type"), F.col("rows"), (F.col("rows") - F.col(f"n{i}")).alias("nulls"), F.col(f"d{i}").alias("distinct_about"), F.col(f"a{i}").alias("min_value"), F.col(f"z{i}").alias("max_value"),
            F.when((F.col(f"n{i}") > 0) & (F.col(f"i{i}") == F.col(f"n{i}")), "integer").when((F.col(f"n{i}") > 0) & (F.col(f"i{i}") + F.col(f"f{i}") == F.col(f"n{i}")), "decimal").otherwise("string").alias("inferred_type"),
        )
        for i, (c, t) in enumerate(simple)
    ]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def run_monitor(audit: DataFrame, now: str, max_age_hours: int = 24) -> DataFrame:
    """Of each dataset: last success, runs by status, and whether it is fresh; datasets that never succeeded aren't."""
    good = F.col("status").startswith("SUCCESS")
    per = audit.groupBy("dataset_id").agg(
        F.max(F.when(good, F.col("completed_at").cast("timestamp_ntz"))).alias("last_success_at"), F.count(F.lit(1)).alias("runs"), F.count_if(F.col("status") == "FAILED").alias("failed_runs"),
    )
    limit = F.lit(now).cast("timestamp_ntz") - F.expr(f"interval {max_age_hours} hours")
    return per.withColumn("fresh", F.coalesce(F.col("last_success_at") >= limit, F.lit(False)))


def evidence_pack(audit: DataFrame, checks: DataFrame, run_id: str) -> DataFrame:
    """The run's audit rows, each with the checks' outcome: passed and failed counts and the names of those that failed."""
    outcome = checks.agg(F.count_if(F.col("test_status") == "PASS").alias("checks_passed"), F.count_if(F.col("test_status") == "FAIL").alias("checks_failed"), F.concat_ws(",", F.sort_array(F.collect_set(F.when(F.col("test_status") == "FAIL", F.col("test_id"))))).alias("failed_checks")).withColumn("run_id", F.lit(run_id))
    return audit.where(F.col("run_id") == run_id).join(outcome, "run_id")


def manifest_differences(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """table_name, row_count, actual_count where a manifest's count isn't what was read; a table that wasn't read counts 0."""
    both = expected.join(actual, "table_name", "left").withColumn("actual_count", F.coalesce("actual_count", F.lit(0)))
    return both.where("row_count <> actual_count").select("table_name", "row_count", "actual_count")
