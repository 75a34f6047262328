"""Header resolution: headers of many systems to canonical fields, in one job.

Input is headers(source_system, ordinal, source_column). Each header is decided by
the first tier that commits to it - recorded override, exact name or synonym,
external proposal, fuzzy match - and a field goes to one column per system.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reqmill.functions import headers as H
from reqmill.functions.scalars import (CONFIDENCE_BUCKETS, confidence_bucket, ratio)
from reqmill.schema import FIELD_NAMES, FIELDS, METHODS, REQUIRED_FIELDS
from reqmill.session import ensure_checkpoint_dir

# Acceptance floors.
PROPOSAL_FLOOR = 0.70
FUZZY_FLOOR = 0.82

# Phrases a header is compared with, in declaration order.
PHRASES = [(phrase, f.name) for f in FIELDS
           for phrase in (f.name.replace("_", " "), *f.synonyms)]
PHRASE_TEXTS = [p for p, _ in PHRASES]
PHRASE_FIELDS = [f for _, f in PHRASES]

_TIER = {"override": 0, "exact": 1, "llm": 2, "fuzzy": 3}


class MappingError(ValueError):
    pass


def _pick(values: Sequence[str], index: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), index)


def exact_dictionary(spark: SparkSession) -> DataFrame:
    """Normal form -> field. A field's own name beats a synonym, then the first wins."""
    entries = spark.createDataFrame(
        [(p, f, 0 if p == f.replace("_", " ") else 1, i) for i, (p, f) in enumerate(PHRASES)],
        "phrase string, exact_field string, kind int, position int")
    return (entries.groupBy(H.normalize(F.col("phrase")).alias("norm"))
            .agg(F.min_by("exact_field", F.struct("kind", "position")).alias("exact_field")))


def invalid_overrides(overrides: DataFrame) -> DataFrame:
    """Overrides that target an unknown field; a null target is allowed."""
    return overrides.where(F.col("canonical_field").isNotNull() & ~F.col("canonical_field").isin(FIELD_NAMES))


def validate_overrides(overrides: DataFrame) -> DataFrame:
    """Raise if there are invalid_overrides(), with their number and the first of them."""
    bad = invalid_overrides(overrides)
    order = ["source_system", "source_column", "canonical_field"]
    first = bad.orderBy(*order).select(*order).take(1)
    if first:
        raise MappingError(f"{bad.count()} override(s) with an unknown canonical field, the first "
                           f"{first[0].source_system}.{first[0].source_column} -> '{first[0].canonical_field}'")
    return overrides


def exact_match(headers: DataFrame) -> DataFrame:
    """Add the normal form and the field it names, if any."""
    named = headers.withColumn("norm", H.normalize(F.col("source_column")))
    # The dictionary is a constant of under a hundred rows.
    return named.join(F.broadcast(exact_dictionary(headers.sparkSession)), "norm", "left")


def fuzzy_match(probe: Column) -> tuple[Column, Column, Column]:
    """(phrase, field, score) of the closest phrase for a probe."""
    best = H.best_phrase(PHRASE_TEXTS)(probe)
    return (_pick(PHRASE_TEXTS, best["phrase"]), _pick(PHRASE_FIELDS, best["phrase"]),
            best["score"])


def spread_texts(texts: DataFrame, column: str) -> DataFrame:
    """The distinct texts, dealt to as many tasks as a shuffle has. A number of partitions
    that is asked for is kept: texts are few bytes and much work, so partitions joined by
    their size would be scored in one task."""
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return texts.select(column).where(F.col(column).isNotNull()).distinct().repartition(parts, column)


def fuzzy_candidates(headers: DataFrame, column: str = "source_column", top_n: int = 3) -> DataFrame:
    """Top fields per header with the phrase and score that put them there. Every distinct
    text is scored once, however many headers share it."""
    rank = H.ranked_phrases(PHRASE_TEXTS, [FIELD_NAMES.index(f) for f in PHRASE_FIELDS], top_n)
    probed = headers.withColumn("_probe", H.probe(F.col(column)))
    ranked = spread_texts(probed, "_probe").withColumn("_found", rank(F.col("_probe")))
    return probed.join(ranked, "_probe").select(*headers.columns, F.posexplode("_found").alias("_i", "_c")).select(
        *headers.columns, (F.col("_i") + 1).alias("candidate_rank"),
        _pick(PHRASE_FIELDS, F.col("_c.phrase")).alias("canonical_field"),
        _pick(PHRASE_TEXTS, F.col("_c.phrase")).alias("matched_phrase"),
        F.col("_c.score").alias("score"))


def _with_overrides(h: DataFrame, overrides: DataFrame | None) -> DataFrame:
    """Join overrides; of repeated ones the last (highest `ordinal`, then field) counts."""
    if overrides is None:
        return h.withColumns({"ov_hit": F.lit(False), "ov_field": F.lit(None).cast("string")})
    last = F.struct(F.col("ordinal") if "ordinal" in overrides.columns else F.lit(0),
                    F.col("canonical_field").alias("field"))
    known = overrides.groupBy("source_system", "source_column").agg(F.max(last)["field"].alias("ov_field")).withColumn(
        "ov_hit", F.lit(True))
    return h.join(known, ["source_system", "source_column"], "left").withColumn(
        "ov_hit", F.coalesce("ov_hit", F.lit(False)))


def _with_proposals(h: DataFrame, proposals: DataFrame | None) -> DataFrame:
    """Join proposals; of repeated ones the last (highest `ordinal`) counts."""
    if proposals is None:
        return h.withColumns({"p": F.lit(None).cast(
            "struct<field:string,confidence:double,reasoning:string>"),
            "proposal_outcome": F.lit(None).cast("string")})
    if "ordinal" not in proposals.columns:
        proposals = proposals.withColumn("ordinal", F.lit(0))
    value = F.struct(
        F.col("canonical_field").alias("field"),
        F.round(F.coalesce(F.col("confidence").cast("double"), F.lit(0.0)), 4).alias("confidence"),
        F.coalesce("reasoning", F.lit("")).alias("reasoning"))
    last = (proposals.groupBy("source_system", "source_column")
            .agg(F.max(F.struct("ordinal", value.alias("v")))["v"].alias("p")))
    joined = h.join(last, ["source_system", "source_column"], "left")
    field = F.col("p.field")
    return joined.withColumn(
        "proposal_outcome",
        F.when(F.col("ov_hit") | F.col("exact_field").isNotNull() | F.col("p").isNull(), None)
        .when(field.isNull(), "declined")
        .when(~field.isin(FIELD_NAMES), "invalid")
        .when(F.col("p.confidence") < PROPOSAL_FLOOR, "low")
        .otherwise("accepted"))


def propose(headers: DataFrame, overrides: DataFrame | None = None,
            proposals: DataFrame | None = None, fuzzy_floor: float = FUZZY_FLOOR) -> DataFrame:
    """The tier each header is decided by, before fields are contested."""
    h = headers.select("source_system", "ordinal", "source_column")
    h = _with_proposals(_with_overrides(exact_match(h), overrides), proposals)
    decided = (F.col("ov_hit") | F.col("exact_field").isNotNull()
               | F.coalesce(F.col("proposal_outcome").isin("accepted", "declined"), F.lit(False)))
    # Only what no other tier decides is scored, and every distinct text once, however
    # many systems use it.
    h = h.withColumn("_probe", F.when(~decided, F.translate("norm", "_", " ")))
    phrase, field, score = fuzzy_match(F.col("_probe"))
    scored = spread_texts(h, "_probe").select(
        "_probe", phrase.alias("fz_phrase"), field.alias("fz_field"), score.alias("fz_score"))
    h = h.join(scored, "_probe", "left").withColumn("fz_score", F.coalesce("fz_score", F.lit(0.0)))
    method = (F.when(F.col("ov_hit"), "override")
              .when(F.col("exact_field").isNotNull(), "exact")
              .when(decided, "llm")
              .when(F.col("fz_score") >= fuzzy_floor, "fuzzy")
              .otherwise("unmapped"))
    h = h.withColumn("method", method)
    by_method = {
        "override": ("ov_field", F.lit(1.0), F.lit("recorded override")),
        "exact": ("exact_field", F.lit(1.0),
                  F.format_string("'%s' is a name of %s", "norm", "exact_field")),
        "llm": ("p.field", F.col("p.confidence"),
                F.when((F.col("p.reasoning") == "") & F.col("p.field").isNull(),
                       "proposal names no field").otherwise(F.col("p.reasoning"))),
        "fuzzy": ("fz_field", F.col("fz_score"),
                  F.format_string("close to '%s', at %.2f", "fz_phrase", "fz_score")),
    }
    # Headers no tier commits to keep the score of the best candidate.
    canonical, confidence = F.lit(None).cast("string"), F.col("fz_score")
    why = F.when(F.col("fz_phrase").isNull(), "nothing to compare").otherwise(F.format_string(
        f"closest is '%s' of %s, at %.2f of the {fuzzy_floor:.2f} needed",
        "fz_phrase", "fz_field", "fz_score"))
    tier = F.lit(_TIER["fuzzy"])
    for name, (target, conf, reason) in by_method.items():
        hit = F.col("method") == name
        canonical = F.when(hit, F.col(target)).otherwise(canonical)
        confidence = F.when(hit, conf).otherwise(confidence)
        why = F.when(hit, reason).otherwise(why)
        tier = F.when(hit, F.lit(_TIER[name])).otherwise(tier)
    return h.select("source_system", "ordinal", "source_column",
                    canonical.alias("canonical_field"), "method", confidence.alias("confidence"),
                    why.alias("reasoning"), tier.alias("tier"), "proposal_outcome")


def assign(claims: DataFrame) -> DataFrame:
    """One column per field: the highest confidence wins, the earliest on ties.

    Claims are committed in (tier, ordinal) order. A claim that does not beat the
    best one before it is refused; the holder is displaced by the first later
    claim that beats it. Both are read off the chain of record holders of a
    (system, field), which has strictly rising confidences of four digits, so it
    stays short however many columns claim the field.
    """
    field = ["source_system", "canonical_field"]
    first_at = (claims.where(F.col("canonical_field").isNotNull())
                .groupBy(*field, "confidence")
                .agg(F.min(F.struct("tier", "ordinal", "source_column")).alias("at")))
    before = (Window.partitionBy(*field).orderBy("at")
              .rowsBetween(Window.unboundedPreceding, -1))
    records = (first_at.withColumn("beaten", F.max("confidence").over(before))
               .where(F.col("beaten").isNull() | (F.col("confidence") > F.col("beaten"))))
    chains = records.groupBy(*field).agg(F.sort_array(F.collect_list(
        F.struct("at.tier", "at.ordinal", "at.source_column", "confidence"))).alias("chain"))

    me = F.struct("tier", "ordinal")
    held = claims.join(chains, field, "left").withColumns({
        "holder": F.try_element_at(
            F.filter("chain", lambda x: F.struct(x["tier"], x["ordinal"]) < me), F.lit(-1)),
        "next": F.get(
            F.filter("chain", lambda x: F.struct(x["tier"], x["ordinal"]) > me), F.lit(0))})
    refused = F.coalesce(F.col("confidence") <= F.col("holder.confidence"), F.lit(False))
    lost = refused | F.col("next").isNotNull()
    reason = (
        F.when(refused, F.format_string(
            "%s is held by '%s', at %.2f",
            "canonical_field", "holder.source_column", "holder.confidence"))
        .when(F.col("next").isNotNull(), F.format_string(
            "%s went to '%s', at %.2f",
            "canonical_field", "next.source_column", "next.confidence"))
        .otherwise(F.col("reasoning")))
    return held.select(
        "source_system", "ordinal", "source_column",
        F.when(~lost, F.col("canonical_field")).alias("canonical_field"),
        F.when(lost, "unmapped").otherwise(F.col("method")).alias("method"),
        "confidence", reason.alias("reasoning"), "proposal_outcome")


def resolve_headers(headers: DataFrame, overrides: DataFrame | None = None,
                    proposals: DataFrame | None = None) -> DataFrame:
    """One decision per header.

    Claims are checkpointed: assignment reads them twice, and would score every
    header again each time.
    """
    ensure_checkpoint_dir(headers.sparkSession)
    return assign(propose(headers, overrides, proposals).checkpoint())


def missing_required(decisions: DataFrame) -> DataFrame:
    """Required fields no column of a system claims, one row each."""
    claimed = decisions.groupBy("source_system").agg(
        F.collect_set(F.when(F.col("canonical_field").isin(REQUIRED_FIELDS),
                             F.col("canonical_field"))).alias("have"))
    required = F.array(*[F.lit(f) for f in REQUIRED_FIELDS])
    return claimed.select("source_system",
                          F.explode(F.array_except(required, "have")).alias("canonical_field"))


def require_fields(decisions: DataFrame) -> DataFrame:
    """Raise if there are missing_required() fields: the number of systems in full, the
    fields of the first few by name."""
    gaps = (missing_required(decisions).groupBy("source_system")
            .agg(F.sort_array(F.collect_list("canonical_field")).alias("fields")))
    shown = gaps.orderBy("source_system").take(5)
    if shown:
        n = gaps.count()
        text = "; ".join(f"[{g.source_system}] {g.fields}" for g in shown)
        more = f"; {n - len(shown)} more, see missing_required()" if n > len(shown) else ""
        raise MappingError(f"required canonical fields left unmapped in {n} system(s): {text}{more}")
    return decisions


def column_map(decisions: DataFrame, source_system: str) -> dict[str, str]:
    """source column -> field of one system; at most one entry per field."""
    mapped = decisions.where((F.col("source_system") == source_system)
                             & F.col("canonical_field").isNotNull())
    return {r.source_column: r.canonical_field
            for r in mapped.select("source_column", "canonical_field").collect()}


def column_maps(decisions: DataFrame) -> dict[str, dict[str, str]]:
    """column_map() of every system, in one job: at most one entry per field each."""
    maps: dict[str, dict[str, str]] = {}
    rows = decisions.where(F.col("canonical_field").isNotNull())
    for r in rows.select("source_system", "source_column", "canonical_field").collect():
        maps.setdefault(r.source_system, {})[r.source_column] = r.canonical_field
    return maps


def flatten(results: DataFrame) -> DataFrame:
    """results(source_system, decisions array) -> one row per decision."""
    return results.select("source_system", F.explode("decisions").alias("d")).select(
        "source_system", "d.*")


# --- measures over decisions ----------------------------------------------

def _is_mapped() -> Column:
    return F.col("canonical_field").isNotNull()


def _count(condition: Column) -> Column:
    return F.count_if(condition)


def mapping_stats(decisions: DataFrame) -> DataFrame:
    """Per system: totals, tiers, rates. Overrides are out of the auto-match rate."""
    auto = F.col("method") != "override"
    # Confidences have four digits; whole ten-thousandths add up in any order.
    units = F.sum(F.when(_is_mapped(), F.round(F.col("confidence") * 10000).cast("bigint")))
    missing = F.array_except(
        F.array(*[F.lit(f) for f in REQUIRED_FIELDS]),
        F.collect_set(F.when(F.col("canonical_field").isin(REQUIRED_FIELDS),
                             F.col("canonical_field"))))
    s = decisions.groupBy("source_system").agg(
        _count(F.lit(True)).alias("columns_total"), _count(_is_mapped()).alias("columns_mapped"),
        *[_count(F.col("method") == m).alias(m) for m in METHODS],
        _count(auto).alias("auto_columns"), _count(auto & _is_mapped()).alias("auto_mapped"),
        units.alias("units"), missing.alias("missing_required"))
    return s.select(
        "source_system", "columns_total", "columns_mapped", *METHODS,
        "auto_columns", "auto_mapped",
        F.coalesce(ratio(F.col("auto_mapped"), F.col("auto_columns")), F.lit(0.0)).alias("auto_match_rate"),
        F.coalesce(ratio(F.col("fuzzy"), F.col("columns_mapped")), F.lit(0.0)).alias("fallback_rate"),
        F.coalesce(ratio(F.col("units") / F.lit(10000.0), F.col("columns_mapped")), F.lit(0.0)).alias("mean_confidence"),
        F.array_join("missing_required", ",").alias("missing_required"))


def mapping_rollup(stats: DataFrame, claims: DataFrame | None = None,
                   rows: DataFrame | None = None) -> DataFrame:
    """The batch over its systems; rates are weighted by columns.

    With claims (decisions with their proposal_outcome) it has the overrides and the
    proposals that were invalid or too low; with rows(source_system, rows_read,
    rows_loaded) the rows in total, and `sources`, an entry for each system.
    """
    totals = _rollup(stats)
    if claims is not None:
        outcome = F.col("proposal_outcome")
        counts = claims.agg(_count(F.col("method") == "override").alias("overrides_applied"),
                            _count(outcome == "invalid").alias("proposals_invalid"),
                            _count(outcome == "low").alias("proposals_low"))
        totals = totals.withColumn("_c", counts.select(F.struct("*")).scalar()).select("*", "_c.*").drop("_c")
    if rows is not None:
        per = stats.join(rows, "source_system", "left").select(
            "source_system", F.coalesce("rows_read", F.lit(0)).alias("rows_read"),
            F.coalesce("rows_loaded", F.lit(0)).alias("rows_loaded"), "columns_total", "columns_mapped", "auto_match_rate")
        counts = per.agg(F.sum("rows_read").alias("rows_read"), F.sum("rows_loaded").alias("rows_loaded"),
                         F.sort_array(F.collect_list(F.struct(*per.columns))).alias("sources"))
        totals = totals.withColumn("_c", counts.select(F.struct("*")).scalar()).select("*", "_c.*").drop("_c")
    return totals


def _rollup(stats: DataFrame) -> DataFrame:
    s = stats.agg(
        F.count("*").alias("source_systems"), F.sum("columns_total").alias("columns_total"),
        F.sum("columns_mapped").alias("columns_mapped"),
        F.sum("auto_mapped").alias("columns_auto_mapped"), F.sum("auto_columns").alias("_auto"),
        *[F.sum(m).alias(m) for m in METHODS],
        F.bool_or(F.col("llm") > 0).alias("llm_used"),
        F.count_if(F.col("missing_required") != "").alias("systems_missing_required"))
    return s.select("source_systems", "columns_total", "columns_mapped", "columns_auto_mapped",
                 F.coalesce(ratio(F.col("columns_auto_mapped"), F.col("_auto")), F.lit(0.0)).alias("auto_match_rate"),
                 *METHODS,
                 F.coalesce(ratio(F.col("fuzzy"), F.col("columns_mapped")), F.lit(0.0)).alias("fallback_rate"),
                 "llm_used", "systems_missing_required")


def mapping_errors(stats: DataFrame) -> DataFrame:
    """Systems that cannot be landed, with the reason."""
    return stats.where(F.col("missing_required") != "").select("source_system", F.concat(
        F.lit("required canonical fields left unmapped: "), "missing_required").alias("error"))


def proposal_counts(claims: DataFrame) -> DataFrame:
    """Per system: proposals by outcome."""
    outcome = F.col("proposal_outcome")
    return claims.groupBy("source_system").agg(
        *[_count(outcome == o).alias(f"proposals_{o}")
          for o in ("accepted", "declined", "invalid", "low")])


def accuracy(decisions: DataFrame, truth: DataFrame) -> DataFrame:
    """Decisions against the known field of every header, per system and in total.

    truth(source_system, source_column, expected); a null `expected` marks an
    operational column that no field should take. A header that is repeated in a
    system counts once, by its first decision.
    """
    key = ["source_system", "source_column"]
    first = decisions.groupBy(*key).agg(F.min_by(F.struct("canonical_field", "method"), "ordinal").alias("d"))
    both = (truth.groupBy(*key).agg(F.max("expected").alias("expected"))
            .join(first, key, "left").select(*key, "expected", "d.*"))
    want, got = F.col("expected"), F.col("canonical_field")
    per_system = both.groupBy("source_system").agg(
        _count(F.lit(True)).alias("columns"), _count(want.isNotNull()).alias("should_map"),
        _count(F.coalesce(got == want, F.lit(False))).alias("correct"),
        _count(want.isNotNull() & got.isNotNull() & (got != want)).alias("mis_mapped"),
        _count(want.isNotNull() & got.isNull()).alias("missed"),
        _count(want.isNull()).alias("operational"),
        _count(want.isNull() & got.isNull()).alias("declined"),
        _count(F.coalesce(F.col("method") == "override", F.lit(False))).alias("overrides"))
    counts = [c for c in per_system.columns if c != "source_system"]
    total = per_system.agg(*[F.sum(c).alias(c) for c in counts]).select(
        F.lit("TOTAL").alias("source_system"), *counts)
    return per_system.unionByName(total).withColumns({
        "recall": ratio(F.col("correct"), F.col("should_map")),
        "precision": ratio(F.col("correct"), F.col("correct") + F.col("mis_mapped"))})


def confidence_histogram(decisions: DataFrame) -> DataFrame:
    """Decisions per confidence bucket, empty buckets included."""
    buckets = decisions.sparkSession.createDataFrame(
        [(b, i) for i, b in enumerate(CONFIDENCE_BUCKETS)], "bucket string, position int")
    counts = decisions.groupBy(
        confidence_bucket(F.col("canonical_field"), F.col("confidence")).alias("bucket")
    ).agg(F.count("*").alias("n"))
    return buckets.join(counts, "bucket", "left").select(
        "bucket", "position", F.coalesce("n", F.lit(0)).alias("columns"))


def counts_by_method(decisions: DataFrame) -> DataFrame:
    """Decisions per tier in fixed order, absent tiers as 0."""
    tiers = decisions.sparkSession.createDataFrame(
        [(m, i, "declined" if m == "unmapped" else "resolved") for i, m in enumerate(METHODS)],
        "method string, position int, kind string")
    counts = decisions.groupBy("method").agg(F.count("*").alias("n"))
    return tiers.join(counts, "method", "left").select(
        "method", "position", "kind", F.coalesce("n", F.lit(0)).alias("columns"))


def live_stats(decisions: DataFrame) -> DataFrame:
    """One row: columns, unrounded auto-match rate and the count of every tier."""
    auto = F.col("method") != "override"
    return decisions.agg(
        _count(F.lit(True)).alias("columns"),
        F.coalesce(_count(auto & _is_mapped()).cast("double") / F.nullif(_count(auto), F.lit(0)),
                   F.lit(0.0)).alias("auto_match_rate"),
        *[_count(F.col("method") == m).alias(m) for m in METHODS])
