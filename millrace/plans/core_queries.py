"""Registered queries of the core operators, with their SQL. Each runs over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import geometry as geo
from millrace.functions import text as tx
from millrace.operators import aggregates as agg
from millrace.operators import balance, components, decisions, duplicates, labels, matching, ranking, representatives, review, small_files, splits
from millrace.operators import relational as rel
from millrace.sinks import export, release
from millrace.sources import fixtures
from millrace.storage import new_path, stage, table

SQL: dict[str, str] = {}
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(sql: str | None = None) -> Callable:
    def register(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


# files


@query()
def p4_found(spark, d):
    """The ids in the files that were written, verified and published."""
    folder = new_path(spark, "label-groups")
    small_files.publish(table(spark, d, "label_files"), folder)
    return small_files.published(spark, folder).select("label_id").distinct()


@query()
def p4_schedule(spark, d):
    return small_files.schedule(table(spark, d, "label_files"), target_bytes=1 << 20)


# scans and projections


@query("SELECT sample_id, filepath, source_dataset FROM samples WHERE list_contains(tags, 'mislabel')")
def tag_filter(spark, d):
    return rel.with_tag(table(spark, d, "samples"), "mislabel").select("sample_id", "filepath", "source_dataset")


@query("SELECT sample_id, status, confidence FROM decisions WHERE lower(status) = 'review' AND phase = 'quality'")
def status_filter(spark, d):
    return table(spark, d, "decisions").filter((F.lower("status") == "review") & (F.col("phase") == "quality")).select("sample_id", "status", "confidence")


@query("SELECT sample_id, list_sort(list_distinct([t FOR t IN coalesce(tags, []) IF NOT starts_with(t, 'curation_')] || ['exported'])) AS tags FROM samples")
def tag_rewrite(spark, d):
    return table(spark, d, "samples").select("sample_id", rel.add_tags(rel.strip_tag_prefix(F.col("tags"), "curation_"), "exported").alias("tags"))


@query(r"SELECT sample_id, sample_id || lower(regexp_extract(filepath, '(\.[^./]+)$', 1)) AS export_name, regexp_extract(filepath, '([^/]+?)(\.[A-Za-z0-9]+)?$', 1) AS stem FROM samples")
def export_names(spark, d):
    return table(spark, d, "samples").select("sample_id", tx.export_name(F.col("sample_id"), F.col("filepath")).alias("export_name"), tx.stem(F.col("filepath")).alias("stem"))


@query("SELECT DISTINCT s.sample_id, s.source_dataset FROM samples s WHERE s.sample_id NOT IN (SELECT sample_id FROM descriptors WHERE sample_id IS NOT NULL)")
def without_descriptor(spark, d):
    return rel.drop_ids(table(spark, d, "samples"), table(spark, d, "descriptors")).select("sample_id", "source_dataset").distinct()


@query("SELECT DISTINCT s.sample_id, s.source_dataset FROM samples s WHERE s.sample_id IN (SELECT sample_id FROM descriptors)")
def with_descriptor(spark, d):
    return rel.keep_ids(table(spark, d, "samples"), table(spark, d, "descriptors")).select("sample_id", "source_dataset").distinct()


@query("SELECT sample_id, coalesce(CASE WHEN NOT isnan(blur_variance) THEN blur_variance END, brightness_mean, -1) AS value FROM quality_metrics")
def first_known_value(spark, d):
    return table(spark, d, "quality_metrics").select("sample_id", rel.first_known(F.col("blur_variance"), F.col("brightness_mean"), default=-1).alias("value"))


@query("SELECT l_orderkey, count(*) FILTER (l_quantity >= 25) AS kept, count(*) AS had, count(*) FILTER (l_quantity >= 25) = 0 AS emptied FROM lineitem GROUP BY 1")
def box_filter(spark, d):
    boxes = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct(F.col("l_quantity").alias("blur_variance"))).alias("b"))
    return boxes.select("l_orderkey", rel.filter_boxes(F.col("b"), 25).alias("f"), "b").select("l_orderkey", F.size("f").cast("long").alias("kept"), F.size("b").cast("long").alias("had"), rel.emptied(F.col("b"), F.col("f")).alias("emptied"))


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_discount + l_tax <= 1 + 1e-9 AND l_tax > 0 THEN true ELSE false END AS valid FROM lineitem")
def box_validity(spark, d):
    box = F.array(F.col("l_discount"), F.lit(0.0), F.col("l_tax"), F.lit(0.5))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", geo.valid_box(box).alias("valid"))


_TURNS_OF = "o AS (SELECT l_orderkey, l_linenumber, l_discount AS x, l_tax AS y, 0.2::DOUBLE AS w, 0.1::DOUBLE AS h FROM lineitem), m AS (SELECT l_orderkey, l_linenumber, '' AS p, x, y, w, h FROM o UNION ALL SELECT l_orderkey, l_linenumber, 'mirror_', 1 - x - w, y, w, h FROM o), t AS (SELECT *, 0 AS q FROM m UNION ALL SELECT l_orderkey, l_linenumber, p, y, 1 - x - w, h, w, 90 FROM m UNION ALL SELECT l_orderkey, l_linenumber, p, 1 - x - w, 1 - y - h, w, h, 180 FROM m UNION ALL SELECT l_orderkey, l_linenumber, p, 1 - y - h, x, h, w, 270 FROM m)"


@query(f"WITH {_TURNS_OF} SELECT l_orderkey, l_linenumber, p || 'r' || q AS transform, round(x, 5) + 0.0 AS x, round(y, 5) + 0.0 AS y, round(w, 5) AS w, round(h, 5) AS h FROM t")
def box_turn(spark, d):
    """Boxes under all eight symmetries."""
    own = F.array(F.col("l_discount"), F.col("l_tax"), F.lit(0.2), F.lit(0.1))
    every = F.array(*(F.struct(F.lit(f"{'mirror_' if m else ''}r{90 * q}").alias("transform"), geo.turn_box(own, m, q).alias("b")) for m in (False, True) for q in range(4)))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.inline(every)).select("l_orderkey", "l_linenumber", "transform", *((F.get("b", i) + F.lit(0.0)).alias(c) for i, c in enumerate("xywh")))  # no negative zero


@query("SELECT event_id, (props::JSON->>'k')::BIGINT AS k, strftime(ts, '%Y%m%d-%H%M%S') AS run_id FROM events")
def json_and_run_ids(spark, d):
    return table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"), F.date_format("ts", "yyyyMMdd-HHmmss").alias("run_id"))


# joins

_LATEST = "one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY decided_at DESC NULLS LAST, phase DESC NULLS LAST, status DESC NULLS LAST, reason DESC NULLS LAST, confidence DESC NULLS LAST) AS place FROM (SELECT DISTINCT sample_id, decided_at, phase, status, reason, confidence FROM decisions WHERE sample_id IS NOT NULL)) WHERE place = 1)"


def _latest_decisions(spark, d):
    return rel.latest(table(spark, d, "decisions").select("sample_id", "decided_at", "phase", "status", "reason", "confidence"), "sample_id", "decided_at", "phase", "status", "reason", "confidence")


@query(f"WITH {_LATEST} SELECT sample_id, status, phase, reason FROM one")
def latest_decision(spark, d):
    return _latest_decisions(spark, d).select("sample_id", "status", "phase", "reason")


@query("SELECT s.sample_id, s.filepath, coalesce(o.license, 'unknown') AS license, coalesce(o.version, 'unknown') AS version, coalesce(o.geography, 'unknown') AS geography FROM samples s LEFT JOIN sources o USING (source_dataset)")
def provenance_join(spark, d):
    return rel.provenance(table(spark, d, "samples"), table(spark, d, "sources"), ["license", "version", "geography"]).select("sample_id", "filepath", "license", "version", "geography")


@query("SELECT left_id, right_id, level FROM duplicate_links WHERE right_id IS NULL OR right_id NOT IN (SELECT sample_id FROM samples WHERE sample_id IS NOT NULL)")
def orphan_links(spark, d):
    return rel.orphans(table(spark, d, "duplicate_links"), table(spark, d, "samples").filter("sample_id is not null"), "right_id", "sample_id").select("left_id", "right_id", "level")


@query("SELECT count(*) AS rows FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def referenced_lines(spark, d):
    urgent = table(spark, d, "orders").filter("o_orderpriority = '1-URGENT'")
    return rel.referenced(table(spark, d, "lineitem"), urgent, "l_orderkey", "o_orderkey").agg(F.count("*").alias("rows"))


_PAIRS = "pairs AS (SELECT least(left_id, right_id) AS a, greatest(left_id, right_id) AS b, level, method, rejected FROM duplicate_links WHERE left_id <> right_id)"


@query(f"WITH {_PAIRS} SELECT DISTINCT a AS left, b AS right, level FROM pairs p WHERE NOT EXISTS (SELECT 1 FROM pairs r WHERE r.rejected AND r.a = p.a AND r.b = p.b)")
def edges_not_rejected(spark, d):
    links = table(spark, d, "duplicate_links").filter("left_id <> right_id").select(*(c.alias(n) for c, n in ((F.least("left_id", "right_id"), "left"), (F.greatest("left_id", "right_id"), "right"))), "level", "rejected")
    return rel.without_rejected(links.select("left", "right", "level"), links.filter("rejected")).distinct()


@query("SELECT sample_id FROM samples WHERE list_contains(tags, 'curation_kept') INTERSECT SELECT sample_id FROM samples WHERE list_contains(tags, 'curation_review')")
def tag_conflicts(spark, d):
    return rel.tag_conflicts(table(spark, d, "samples"), "curation_kept", "curation_review")


@query("SELECT DISTINCT sample_id FROM decisions WHERE lower(status) = 'review' AND sample_id NOT IN (SELECT sample_id FROM samples WHERE list_contains(tags, 'curation_kept') AND sample_id IS NOT NULL)")
def unresolved_reviews(spark, d):
    return rel.drop_ids(table(spark, d, "decisions").filter(F.lower("status") == "review").select("sample_id").distinct(), rel.with_tag(table(spark, d, "samples"), "curation_kept"))


@query("SELECT sample_id, coalesce(n.status, s.source_split) AS source_split FROM (SELECT DISTINCT sample_id, source_split FROM samples WHERE sample_id IS NOT NULL) s LEFT JOIN (SELECT sample_id, max(status) AS status FROM decisions WHERE sample_id IS NOT NULL GROUP BY 1) n USING (sample_id)")
def keyed_update(spark, d):
    new = table(spark, d, "decisions").filter("sample_id is not null").groupBy("sample_id").agg(F.max("status").alias("source_split"))
    return rel.update_columns(table(spark, d, "samples").filter("sample_id is not null").select("sample_id", "source_split").distinct(), new, "sample_id")


@query("SELECT r.source_dataset, count(*) AS rows, count(coalesce(a.geography, b.geography)) AS known FROM samples r LEFT JOIN sources a ON a.source_dataset = r.source_dataset LEFT JOIN (SELECT homepage, any_value(geography) AS geography FROM sources GROUP BY 1) b ON b.homepage = r.source_dataset GROUP BY 1")
def registry_either_key(spark, d):
    out = rel.either_key(table(spark, d, "samples").select("source_dataset"), table(spark, d, "sources"), "source_dataset", "source_dataset", "homepage", "geography")
    return out.groupBy("source_dataset").agg(F.count("*").alias("rows"), F.count("geography").alias("known"))


@query("SELECT source_dataset, capture_group FROM samples WHERE source_split = 'train' AND source_dataset IS NOT NULL AND capture_group IS NOT NULL INTERSECT SELECT source_dataset, capture_group FROM samples WHERE source_split = 'test' AND source_dataset IS NOT NULL AND capture_group IS NOT NULL")
def capture_leaks(spark, d):
    s = table(spark, d, "samples")
    return rel.leaks_between(s.filter("source_split = 'train'"), s.filter("source_split = 'test'"), "source_dataset", "capture_group")


# aggregates


@query("SELECT lower(status) AS status, count(*) AS rows FROM decisions GROUP BY 1")
def status_counts(spark, d):
    return agg.counts(table(spark, d, "decisions"), F.lower("status").alias("status"))


_WITH_SOURCE = f"{_LATEST}, src AS (SELECT sample_id, min(source_dataset) AS source_dataset, min(source_label) AS source_label FROM samples WHERE sample_id IS NOT NULL GROUP BY 1), dec AS (SELECT one.*, source_dataset, source_label FROM one JOIN src USING (sample_id))"


def _with_source(spark, d):
    src = table(spark, d, "samples").filter("sample_id is not null").groupBy("sample_id").agg(F.min("source_dataset").alias("source_dataset"), F.min("source_label").alias("source_label"))
    return _latest_decisions(spark, d).join(src, "sample_id")


@query(f"WITH {_WITH_SOURCE} SELECT source_dataset, count(*) FILTER (lower(status) = 'kept') AS kept, count(*) FILTER (lower(status) = 'review') AS review, count(*) FILTER (lower(status) = 'removed') AS removed, count(*) FILTER (lower(status) = 'removed' AND NOT coalesce(phase LIKE '%duplicates', false)) AS removed_quality, count(*) FILTER (lower(status) = 'removed' AND phase LIKE '%duplicates') AS removed_duplicates, count(*) AS total FROM dec GROUP BY 1")
def status_by_source(spark, d):
    return agg.status_pivot(_with_source(spark, d), "source_dataset")


@query(f"WITH {_WITH_SOURCE} SELECT source_dataset, count(*) AS total, count(*) FILTER (lower(status) = 'removed') AS removed, round(count(*) FILTER (lower(status) = 'removed') * 100.0::DOUBLE / count(*), 4) AS drop_rate FROM dec GROUP BY 1")
def drop_rates(spark, d):
    return agg.drop_rates(_with_source(spark, d), "source_dataset")


@query("SELECT source_dataset, task_type, count(*) AS rows FROM samples GROUP BY GROUPING SETS ((source_dataset), (task_type), ()) HAVING true")
def grouping_sets(spark, d):
    return agg.grouping_report(table(spark, d, "samples"), "source_dataset", "task_type").select("source_dataset", "task_type", "rows")


@query("SELECT source_label, count(*) AS rows, count(DISTINCT source_dataset) AS sources, coalesce(list_sort(list(DISTINCT source_dataset) FILTER (source_dataset IS NOT NULL)), []) AS source_list FROM samples GROUP BY 1")
def label_sources(spark, d):
    return agg.label_sources(table(spark, d, "samples"), "source_label", "source_dataset")


@query("SELECT p_brand, sum(n)::BIGINT AS total, list_sort(list(p_type || '=' || n)) AS by_type, list_sort(list_distinct(flatten(list(names)))) AS raw_labels FROM (SELECT p_brand, p_type, count(*) AS n, list(DISTINCT p_name) AS names FROM part GROUP BY 1, 2) GROUP BY 1")
def canonical_matrix(spark, d):
    m = agg.canonical_matrix(table(spark, d, "part"), "p_brand", "p_name", "p_type")
    of = F.array_sort(F.transform(F.map_entries("by_source"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))))
    return m.select("p_brand", "total", of.alias("by_type"), "raw_labels")


@query("WITH c AS (SELECT event_type, count(*) AS rows FROM events WHERE event_type IS NOT NULL GROUP BY 1), t AS (SELECT sum(rows) AS n, count(*) AS k FROM c) SELECT event_type, rows, round_even(n / (k * rows)::DOUBLE, 4) AS weight FROM c, t")
def class_weights(spark, d):
    return agg.class_weights(table(spark, d, "events"), "event_type")


_TARGETS = "c AS (SELECT label, count(*) AS rows FROM embeddings WHERE label IS NOT NULL GROUP BY 1), t AS (SELECT max(rows) AS a, round_even(avg(rows), 0)::BIGINT AS b, round_even(quantile_cont(rows, 0.5), 0)::BIGINT AS m FROM c)"


@query(f"WITH {_TARGETS} SELECT label, rows, least(2000, greatest(0, a - rows)) AS missing_max, least(2000, greatest(0, b - rows)) AS missing_mean, least(2000, greatest(0, m - rows)) AS missing_median FROM c, t")
def balance_targets(spark, d):
    return agg.balance_targets(table(spark, d, "embeddings"), "label")


@query("SELECT count(*) AS rows, count(*) FILTER (is_corrupted) AS corrupted, count(*) FILTER (processing_error) AS errors, count(*) FILTER (has_watermark) AS watermarked, count(*) FILTER (low_resolution) AS low_resolution, round(avg(blur_variance) FILTER (blur_variance >= 0 AND NOT isnan(blur_variance)), 4) AS mean_blur, round(avg(brightness_mean), 4) AS mean_brightness, min(width::BIGINT * height) FILTER (width > 0 AND height > 0) AS least_area, max(width::BIGINT * height) FILTER (width > 0 AND height > 0) AS greatest_area, quantile_cont(blur_variance, 0.5) FILTER (blur_variance >= 0 AND NOT isnan(blur_variance)) AS median_blur FROM quality_metrics")
def quality_summary(spark, d):
    return agg.quality_summary(table(spark, d, "quality_metrics"))


@query("SELECT lower(asset_sha256) AS digest, count(DISTINCT sample_id) AS members, min(sample_id) AS first FROM quality_metrics WHERE asset_sha256 <> '' GROUP BY 1 HAVING count(DISTINCT sample_id) > 1")
def exact_duplicate_groups(spark, d):
    return agg.equal_groups(table(spark, d, "quality_metrics").withColumn("digest", F.lower("asset_sha256")), "digest", "sample_id")


@query("SELECT text, count(*) AS rows, count(DISTINCT source) AS labels FROM documents WHERE text <> '' GROUP BY 1 HAVING count(DISTINCT source) > 1")
def conflicting_duplicates(spark, d):
    return agg.contradictions(table(spark, d, "documents"), "text", "source")


_SRC = "src AS (SELECT sample_id, min(source_dataset) AS s FROM samples WHERE sample_id IS NOT NULL GROUP BY 1)"


@query(f"WITH {_PAIRS}, {_SRC}, u AS (SELECT DISTINCT a, b FROM pairs) SELECT least(x.s, y.s) AS source_a, greatest(x.s, y.s) AS source_b, count(*) AS pairs FROM u JOIN src x ON x.sample_id = u.a JOIN src y ON y.sample_id = u.b WHERE x.s <> y.s GROUP BY 1, 2")
def cross_source_contamination(spark, d):
    pairs = table(spark, d, "duplicate_links").filter("left_id <> right_id").select(F.least("left_id", "right_id").alias("left"), F.greatest("left_id", "right_id").alias("right")).distinct()
    of = table(spark, d, "samples").filter("sample_id is not null").groupBy("sample_id").agg(F.min("source_dataset").alias("source_dataset"))
    return agg.contamination(rel.pair_sources(pairs, of))


@query("SELECT reason, count(*) AS rows FROM decisions WHERE reason IS NOT NULL GROUP BY 1 ORDER BY rows DESC, reason LIMIT 10")
def top_reasons(spark, d):
    return agg.top_reasons(table(spark, d, "decisions"))


@query("SELECT level, coalesce(rejected, false) AS rejected, count(*) AS rows FROM duplicate_links GROUP BY 1, 2")
def pair_levels(spark, d):
    return agg.counts(table(spark, d, "duplicate_links"), "level", F.coalesce("rejected", F.lit(False)).alias("rejected"))


@query("SELECT DISTINCT source_label FROM samples WHERE source_label IS NOT NULL")
def class_list(spark, d):
    return table(spark, d, "samples").select("source_label").filter("source_label is not null").distinct()


@query("WITH c AS (SELECT source_dataset, count(*) FILTER (is_corrupted)::DOUBLE AS k, count(*)::DOUBLE AS n FROM quality_metrics JOIN (SELECT sample_id, min(source_dataset) AS source_dataset FROM samples WHERE sample_id IS NOT NULL GROUP BY 1) USING (sample_id) GROUP BY 1), z AS (SELECT 1.959963984540054::DOUBLE AS z) SELECT source_dataset, k::BIGINT AS hits, n::BIGINT AS trials, round(greatest(0.0, ((k/n + z*z/(2*n)) - z * sqrt(k/n*(1-k/n)/n + z*z/(4*n*n))) / (1 + z*z/n)), 6) AS low, round(least(1.0, ((k/n + z*z/(2*n)) + z * sqrt(k/n*(1-k/n)/n + z*z/(4*n*n))) / (1 + z*z/n)), 6) AS high FROM c, z")
def wilson_interval(spark, d):
    of = table(spark, d, "samples").filter("sample_id is not null").groupBy("sample_id").agg(F.min("source_dataset").alias("source_dataset"))
    c = table(spark, d, "quality_metrics").join(of, "sample_id").groupBy("source_dataset").agg(F.count_if("is_corrupted").alias("hits"), F.count("*").alias("trials"))
    low, high = agg.wilson(F.col("hits"), F.col("trials"))
    return c.select("source_dataset", "hits", "trials", F.round(low, 6).alias("low"), F.round(high, 6).alias("high"))


@query(f"WITH {_PAIRS}, f AS (SELECT DISTINCT a, b FROM pairs WHERE method = 'redundant_augmented'), t AS (SELECT DISTINCT a, b FROM pairs WHERE level IN ('exact_bytes', 'exact_pixels')), h AS (SELECT count(*) AS n FROM (SELECT * FROM f INTERSECT SELECT * FROM t)) SELECT h.n AS hits, (SELECT count(*) FROM f) AS found, (SELECT count(*) FROM t) AS true_pairs, round(h.n / (SELECT count(*) FROM f)::DOUBLE, 6) AS precision, round(h.n / (SELECT count(*) FROM t)::DOUBLE, 6) AS recall FROM h")
def precision_recall(spark, d):
    pairs = table(spark, d, "duplicate_links").filter("left_id <> right_id").select(F.least("left_id", "right_id").alias("a"), F.greatest("left_id", "right_id").alias("b"), "level", "method")
    return agg.precision_recall(pairs.filter("method = 'redundant_augmented'"), pairs.filter("level in ('exact_bytes', 'exact_pixels')"), "a", "b")


# ordered


@query("SELECT sample_id, cluster_id FROM (SELECT sample_id, cluster_id, row_number() OVER (PARTITION BY cluster_id ORDER BY confidence DESC NULLS LAST, sample_id) AS place FROM (SELECT sample_id, cluster_id, max(confidence) AS confidence FROM decisions WHERE cluster_id IS NOT NULL AND sample_id IS NOT NULL GROUP BY 1, 2)) WHERE place = 1")
def representative_rank(spark, d):
    own = table(spark, d, "decisions").filter("cluster_id is not null and sample_id is not null").groupBy("sample_id", "cluster_id").agg(F.max("confidence").alias("confidence"))
    return ranking.first_of_each(own, "cluster_id", 1, F.desc_nulls_last("confidence"), "sample_id").select("sample_id", "cluster_id")


@query("WITH c AS (SELECT DISTINCT sample_id, cluster_id FROM decisions WHERE cluster_id IS NOT NULL AND sample_id IS NOT NULL), q AS (SELECT sample_id, max(width::BIGINT * height) AS area, max(CASE WHEN NOT isnan(blur_variance) THEN blur_variance END) AS sharpness, bool_or(is_corrupted) AS a, bool_or(has_watermark) AS b, bool_or(has_smearing) AS s, bool_or(low_resolution) AS l FROM quality_metrics GROUP BY 1), f AS (SELECT sample_id, min(filepath) AS filepath FROM samples GROUP BY 1) SELECT sample_id, cluster_id, row_number() OVER (PARTITION BY cluster_id ORDER BY coalesce(a, false), coalesce(b, false), coalesce(s, false), coalesce(l, false), coalesce(area, 0) DESC, coalesce(sharpness, 0) DESC, regexp_matches(lower(coalesce(filepath, '')), '\\.rf\\.|_aug|augmentation'), sample_id) AS place FROM c LEFT JOIN q USING (sample_id) LEFT JOIN f USING (sample_id)")
def keep_ranking(spark, d):
    """Members of clusters by all keys of the best copy."""
    members = table(spark, d, "decisions").filter("cluster_id is not null and sample_id is not null").select("sample_id", "cluster_id").distinct()
    facts = table(spark, d, "quality_metrics").groupBy("sample_id").agg(F.max(F.col("width").cast("long") * F.col("height")).alias("area"), F.max(F.when(~F.isnan("blur_variance"), F.col("blur_variance"))).alias("sharpness"), *(F.max(c).alias(c) for c in ("is_corrupted", "has_watermark", "has_smearing", "low_resolution")))
    names = table(spark, d, "samples").groupBy("sample_id").agg(F.min("filepath").alias("filepath"))
    own = members.join(facts, "sample_id", "left").join(names, "sample_id", "left")
    return ranking.ranked(own.withColumn("r", representatives.keep_rank(own)), "cluster_id", "r").select("sample_id", "cluster_id", F.col("place").cast("long").alias("place"))


@query("SELECT arg_min(sample_id, (width::BIGINT * height, sample_id)) AS smallest, arg_max(sample_id, (width::BIGINT * height, sample_id)) AS largest FROM quality_metrics WHERE width > 0 AND height > 0 AND sample_id IS NOT NULL")
def quality_extremes(spark, d):
    """Which samples have the smallest and the largest picture."""
    own = table(spark, d, "quality_metrics").filter("width > 0 and height > 0 and sample_id is not null")
    k = F.struct(F.col("width").cast("long") * F.col("height"), F.col("sample_id"))
    return own.agg(F.min_by("sample_id", k).alias("smallest"), F.max_by("sample_id", k).alias("largest"))


@query("SELECT reason, sample_id FROM (SELECT reason, sample_id, row_number() OVER (PARTITION BY reason ORDER BY sample_id) AS place FROM (SELECT DISTINCT reason, sample_id FROM decisions WHERE reason IS NOT NULL AND sample_id IS NOT NULL)) WHERE place <= 24")
def examples_per_reason(spark, d):
    rows = table(spark, d, "decisions").filter("reason is not null and sample_id is not null").select("reason", "sample_id").distinct()
    return ranking.first_of_each(rows, "reason", 24, "sample_id").select("reason", "sample_id")


@query("WITH k AS (SELECT DISTINCT source_dataset, sample_id FROM samples WHERE source_dataset IS NOT NULL AND sample_id IS NOT NULL), p AS (SELECT *, row_number() OVER (PARTITION BY source_dataset ORDER BY sample_id) AS n FROM k) SELECT a.source_dataset, a.sample_id AS left, b.sample_id AS right FROM p a JOIN p b ON a.source_dataset = b.source_dataset AND b.n > a.n AND b.n - a.n <= 3")
def bucket_window(spark, d):
    keys = table(spark, d, "samples").filter("source_dataset is not null and sample_id is not null")
    out = ranking.bucket_neighbours(keys.select("source_dataset", "sample_id"), "source_dataset", "sample_id", 3)
    return out.join(keys.select(F.col("sample_id").alias("left"), "source_dataset").distinct(), "left").join(keys.select(F.col("sample_id").alias("right"), "source_dataset").distinct(), ["right", "source_dataset"]).select("source_dataset", "left", "right").distinct()


@query("WITH c AS (SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity, l_linenumber, l_extendedprice, l_partkey, l_suppkey) AS n, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber, l_extendedprice, l_partkey, l_suppkey) AS m FROM lineitem) SELECT l_orderkey, l_linenumber, n AS by_near, m AS by_alike FROM c WHERE n <= 2 OR m <= 2")
def two_signal_top(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_partkey", "l_suppkey")
    return ranking.two_signals(rows, "l_orderkey", F.col("l_quantity"), F.col("l_extendedprice"), 2, "l_linenumber", "l_extendedprice", "l_partkey", "l_suppkey").select("l_orderkey", "l_linenumber", F.col("by_near").cast("long").alias("by_near"), F.col("by_alike").cast("long").alias("by_alike"))


# duplicates


@query('''WITH m AS (SELECT DISTINCT sample_id, lower(trim(asset_sha256)) AS g FROM quality_metrics WHERE trim(asset_sha256) <> '' AND sample_id IS NOT NULL), f AS (SELECT g, min(sample_id) AS l FROM m GROUP BY 1) SELECT DISTINCT l AS "left", sample_id AS "right" FROM m JOIN f USING (g) WHERE l <> sample_id''')
def exact_edges(spark, d):
    return duplicates.exact_edges(table(spark, d, "quality_metrics"))


_WALK = "both_ways AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges), walk(v, c) AS (SELECT DISTINCT a, a FROM both_ways UNION SELECT e.b, w.c FROM walk w JOIN both_ways e ON e.a = w.v)"


@query(f"WITH RECURSIVE {_PAIRS}, edges AS (SELECT DISTINCT a, b FROM pairs WHERE level IN ('exact_bytes', 'exact_pixels')), {_WALK} SELECT v, min(c) AS component FROM walk GROUP BY 1")
def connected_components(spark, d):
    links = table(spark, d, "duplicate_links").filter("level in ('exact_bytes', 'exact_pixels')")
    return components.components(links.select(F.col("left_id").alias("left"), F.col("right_id").alias("right")))


@query(f"WITH RECURSIVE edges AS (SELECT sample_id AS a, '~0|' || source_dataset || '|' || capture_group AS b FROM samples WHERE trim(capture_group) <> '' AND sample_id IS NOT NULL AND source_dataset IS NOT NULL UNION SELECT sample_id, '~1|' || source_dataset || '|' || video_id FROM samples WHERE trim(video_id) <> '' AND sample_id IS NOT NULL AND source_dataset IS NOT NULL), {_WALK} SELECT v, min(c) AS component FROM walk WHERE v NOT LIKE '~%' GROUP BY 1")
def families(spark, d):
    none = spark.createDataFrame([], "left string, right string")
    return duplicates.families(table(spark, d, "samples"), none)


_KEY = "regexp_replace(lower({}), '[\\s_-]+', '', 'g')"
_NOTHING = str(tuple(tx.UNKNOWN))
_FAMILIES = f"""own AS (SELECT DISTINCT sample_id, {_KEY.format('source_dataset')} AS s, {_KEY.format('capture_group')} AS k0, {_KEY.format('video_id')} AS k1, {_KEY.format('location')} AS k2, {_KEY.format('duplicate_cluster_id')} AS k9 FROM samples WHERE sample_id IS NOT NULL),
keys AS (SELECT sample_id AS l, '~0|' || s || '|' || k0 AS r FROM own WHERE k0 NOT IN {_NOTHING} AND s NOT IN {_NOTHING} UNION SELECT sample_id, '~1|' || s || '|' || k1 FROM own WHERE k1 NOT IN {_NOTHING} AND s NOT IN {_NOTHING} UNION SELECT sample_id, '~2|' || s || '|' || k2 FROM own WHERE k2 NOT IN {_NOTHING} AND s NOT IN {_NOTHING} UNION SELECT sample_id, '~9|' || k9 FROM own WHERE k9 NOT IN {_NOTHING}
  UNION SELECT a, b FROM (SELECT least(left_id, right_id) AS a, greatest(left_id, right_id) AS b FROM duplicate_links WHERE left_id <> right_id GROUP BY 1, 2 HAVING NOT bool_or(coalesce(rejected, false)) AND bool_or(coalesce(level IN ('exact_bytes', 'exact_pixels', 'verified_visual', 'human_confirmed'), false))) WHERE a IN (SELECT sample_id FROM own) AND b IN (SELECT sample_id FROM own)),
ends AS (SELECT l AS a, r AS b FROM keys UNION SELECT r, l FROM keys),
walk(v, c) AS (SELECT DISTINCT a, a FROM ends WHERE a NOT LIKE '~%' UNION SELECT e.b, least(w.c, CASE WHEN e.b LIKE '~%' THEN w.c ELSE e.b END) FROM walk w JOIN ends e ON e.a = w.v),
fam AS (SELECT o.sample_id, coalesce(min(w.c), o.sample_id) AS group_id FROM (SELECT DISTINCT sample_id FROM own) o LEFT JOIN walk w ON w.v = o.sample_id GROUP BY o.sample_id)"""


@query(f"WITH RECURSIVE {_FAMILIES} SELECT sample_id, group_id FROM fam")
def sample_families(spark, d):
    """Every sample with its family: all four keys and the links."""
    return duplicates.all_families(table(spark, d, "samples"), table(spark, d, "duplicate_links"))


@query("SELECT sample_id, pos, bit_count(xor(phashes[1], phashes[pos])) AS bits FROM (SELECT DISTINCT sample_id, phashes FROM descriptors WHERE phashes IS NOT NULL), unnest(range(2, 9)) AS u(pos) WHERE phashes[1] IS NOT NULL AND phashes[pos] IS NOT NULL")
def hamming_of_variants(spark, d):
    own = table(spark, d, "descriptors").filter("phashes is not null").select("sample_id", "phashes").distinct()
    flat = own.select("sample_id", F.get("phashes", 0).alias("a"), F.posexplode("phashes").alias("pos", "b")).filter("pos > 0 and a is not null and b is not null")
    return flat.select("sample_id", (F.col("pos") + 1).cast("long").alias("pos"), F.bit_count(F.col("a").bitwiseXOR(F.col("b"))).cast("int").alias("bits"))


@query("SELECT a.vec_id AS left, b.vec_id AS right, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS similarity FROM embeddings a JOIN embeddings b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) >= 0.30")
def semantic_neighbours(spark, d):
    e = table(spark, d, "embeddings")
    found = duplicates.all_semantic_pairs(e, "vec_id", "embedding", 0.30, e.filter("vec_id % 50 = 0"))
    return found.select(F.col("query").alias("left"), F.col("other").alias("right"), F.round("similarity", 6).alias("similarity"))


@query("SELECT a.vec_id AS left, b.vec_id AS right, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS similarity FROM embeddings a JOIN embeddings b ON a.vec_id < b.vec_id WHERE list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) >= 0.4")
def semantic_pairs(spark, d):
    return duplicates.semantic_pairs(table(spark, d, "embeddings"), "vec_id", "embedding", 0.4).select("left", "right", F.round("similarity", 6).alias("similarity"))


_UNIT = "flat AS (SELECT vec_id, label, unnest(range(1, len(embedding) + 1)) AS i, unnest(embedding)::DOUBLE AS x FROM embeddings), n AS (SELECT vec_id, sqrt(sum(x * x)) AS n FROM flat GROUP BY 1), u AS (SELECT vec_id, label, i, x / n AS x FROM flat JOIN n USING (vec_id)), m AS (SELECT label, i, avg(x) AS c FROM u GROUP BY 1, 2), l AS (SELECT label, sqrt(sum(c * c)) AS l FROM m GROUP BY 1), cen AS (SELECT label, i, c / l AS c FROM m JOIN l USING (label)), dist AS (SELECT u.vec_id, u.label, cen.label AS other, 1 - sum(u.x * cen.c) AS d FROM u JOIN cen USING (i) GROUP BY 1, 2, 3)"


@query(f"WITH {_UNIT} SELECT vec_id, label, arg_min(other, d) FILTER (other <> label) AS nearer, round(min(d) FILTER (other = label), 6) AS own_distance, round(min(d) FILTER (other <> label), 6) AS nearer_distance FROM dist GROUP BY 1, 2 HAVING min(d) FILTER (other = label) > min(d) FILTER (other <> label) + 0.05")
def mislabel_candidates(spark, d):
    e = table(spark, d, "embeddings")
    return duplicates.mislabelled(e, agg.centroids(e, "label", "embedding"), "vec_id", "label", "embedding")


@query()
def candidate_bands(spark, d):
    return duplicates.band_keys(table(spark, d, "descriptors")).groupBy("bucket").agg(F.count("*").alias("members"))


_LOOKS = "one AS (SELECT sample_id, arg_max(phashes, (computed_at IS NOT NULL, computed_at)) AS h, arg_max(histogram, (computed_at IS NOT NULL, computed_at)) AS x FROM descriptors WHERE sample_id IS NOT NULL AND len(phashes) = 8 AND len([1 FOR v IN phashes IF v IS NULL]) = 0 AND len(histogram) = 512 AND len([1 FOR v IN histogram IF v IS NULL OR isnan(v) OR isinf(v)]) = 0 GROUP BY 1), l AS MATERIALIZED (SELECT sample_id, h, [v::DOUBLE FOR v IN x]::DOUBLE[512] AS x, len([1 FOR v IN x IF v <> 0]) > 0 AS some FROM one)"


def _looks(spark, d):
    fine = F.forall("phashes", lambda h: h.isNotNull()) & (F.size("phashes") == 8) & (F.size("histogram") == 512) & F.forall("histogram", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    own = table(spark, d, "descriptors").filter("sample_id is not null").filter(fine)
    return own.groupBy("sample_id").agg(*(F.max_by(c, F.struct(F.col("computed_at").isNotNull(), F.col("computed_at"))).alias(c) for c in ("phashes", "histogram")))


@query(f"WITH {_LOOKS}, p AS (SELECT a.sample_id AS query, b.sample_id AS other, list_min([bit_count(xor(a.h[1], v)) FOR v IN b.h])::INTEGER AS distance, CASE WHEN a.some AND b.some THEN array_cosine_similarity(a.x, b.x) ELSE 0 END AS s FROM l a JOIN l b ON a.sample_id <> b.sample_id) SELECT query, other, distance FROM p WHERE distance <= 12 OR s >= 0.92")
def similar_pictures(spark, d):
    """All pairs within 12 bits or of colours of at least 0.92, copies among them."""
    return matching.scored(_looks(spark, d), neighbours=None).select("query", "other", "distance")


@query()
def similar_pictures_top(spark, d):
    """Of each picture the 20 nearest by hash and the 20 most alike in colour among those."""
    return matching.scored(_looks(spark, d)).select("query", "other", "distance", F.round("similarity", 4).alias("similarity"))


@query()
def duplicate_benchmark(spark, d):
    """The duplicate run over six families of fifteen made-up pictures: members found by transformation."""
    images = fixtures.benchmark_images(spark, 6)
    _, pairs = matching.detect(images, new_path(spark, "descriptor-cache"))
    return matching.evaluate(pairs, images.select("sample_id", "family", "transformation", "source"))["by_transformation"]


@query()
def representative_assignment(spark, d):
    links = table(spark, d, "duplicate_links").filter("left_id <> right_id and level in ('exact_bytes', 'exact_pixels')").select(F.least("left_id", "right_id").alias("left"), F.greatest("left_id", "right_id").alias("right"), "level").distinct()
    parts = components.components(links)
    facts = table(spark, d, "quality_metrics").groupBy("sample_id").agg(F.max(F.col("width") * F.col("height")).alias("area"), F.max(F.when(~F.isnan("blur_variance"), F.col("blur_variance"))).alias("sharpness"), *(F.max(c).alias(c) for c in ("is_corrupted", "has_watermark", "has_smearing", "low_resolution")))
    names = table(spark, d, "samples").groupBy("sample_id").agg(F.min("filepath").alias("filepath"))
    known = parts.select(F.col("v").alias("sample_id")).join(facts, "sample_id", "left").join(names, "sample_id", "left").withColumn("padding", F.lit(0.0))
    return representatives.assign(parts, links, known)


# decisions

_METRICS = "SELECT sample_id, measured_at, CASE WHEN processing_error THEN 'processing_error' WHEN is_corrupted THEN 'corrupted' WHEN has_watermark THEN 'watermark' WHEN low_resolution THEN 'low_resolution' WHEN has_smearing THEN 'smearing' WHEN b >= 0 AND b < 15 THEN 'severe_blur' WHEN b >= 0 AND b < 25 THEN 'blur' WHEN brightness_mean < 18 OR brightness_mean > 245 THEN 'brightness' WHEN brightness_p95 < 45 OR brightness_p5 > 210 THEN 'exposure' ELSE 'quality_ok' END AS reason FROM (SELECT *, CASE WHEN NOT isnan(blur_variance) THEN blur_variance END AS b FROM quality_metrics)"


_VERDICT = "CASE reason WHEN 'processing_error' THEN ('review', 1.0) WHEN 'corrupted' THEN ('removed', 1.0) WHEN 'watermark' THEN ('removed', 0.99) WHEN 'low_resolution' THEN ('removed', 0.98) WHEN 'smearing' THEN ('removed', 0.92) WHEN 'severe_blur' THEN ('removed', 0.94) WHEN 'blur' THEN ('review', 0.72) WHEN 'brightness' THEN ('removed', 0.9) WHEN 'exposure' THEN ('review', 0.7) ELSE ('kept', 1.0) END"


@query(f"SELECT sample_id, (measured_at::VARCHAR)[1:19] AS at, reason, v[1] AS status, v[2]::DOUBLE AS confidence FROM (SELECT *, {_VERDICT} AS v FROM ({_METRICS}))")
def quality_cascade(spark, d):
    rows = table(spark, d, "quality_metrics").withColumn("r", decisions.quality_rules())
    return rows.select("sample_id", F.date_format("measured_at", "yyyy-MM-dd HH:mm:ss").alias("at"), "r.reason", "r.status", "r.confidence")


@query(f"""WITH {_WITH_SOURCE},
first AS (SELECT sample_id, min(reason) AS reason FROM (SELECT sample_id, reason, rank() OVER (PARTITION BY sample_id ORDER BY measured_at DESC NULLS LAST) AS n FROM ({_METRICS}) WHERE sample_id IS NOT NULL) WHERE n = 1 GROUP BY 1),
j AS (SELECT d.sample_id, d.source_dataset AS g, lower(d.status) = 'removed' AS before, f.reason, {_VERDICT.replace("reason WHEN", "f.reason WHEN")} AS v FROM dec d JOIN first f USING (sample_id)),
g AS (SELECT g, count(*) AS n, count(*) FILTER (NOT coalesce(before, false) AND v[1] = 'removed') AS p, count(*) FILTER (before) AS b FROM j GROUP BY 1),
k AS (SELECT j.*, coalesce(p / n::DOUBLE > 0.2 OR (p + b) / n::DOUBLE > 0.65, false) AND v[1] = 'removed' AND v[2] < 0.98 AS braked FROM j JOIN g ON g.g IS NOT DISTINCT FROM j.g WHERE NOT coalesce(before, false))
SELECT sample_id, CASE WHEN braked THEN 'review' ELSE v[1] END AS status, CASE WHEN braked THEN 'second_opinion_' ELSE '' END || reason AS reason, v[2]::DOUBLE AS confidence FROM k""")
def quality_phase(spark, d):
    """The rules on each sample's latest metrics (of several at once the first reason by name), and the brake."""
    rules = table(spark, d, "quality_metrics").filter("sample_id is not null").withColumn("r", decisions.quality_rules())
    last = rules.groupBy("sample_id").agg(F.max(F.struct(F.col("measured_at").isNotNull(), F.col("measured_at"))).alias("m"))
    now = rules.join(last, "sample_id").filter(F.struct(F.col("measured_at").isNotNull(), F.col("measured_at")) == F.col("m"))
    one = now.groupBy("sample_id").agg(F.min_by("r", "r.reason").alias("r"))
    return decisions.quality_phase(_with_source(spark, d).select("sample_id", "source_dataset", "status").join(one, "sample_id"), F.col("r"), ["source_dataset"], 0.2).select("sample_id", "status", "reason", "confidence")


@query(f"WITH {_WITH_SOURCE}, g AS (SELECT source_dataset AS s, count(*) AS n, count(*) FILTER (lower(status) = 'removed') AS r FROM dec GROUP BY 1) SELECT sample_id, coalesce(lower(status) = 'removed' AND (coalesce(confidence, 0) < 0.98 OR phase LIKE '%duplicates') AND r / n::DOUBLE > 0.10, false) AS braked, CASE WHEN coalesce(lower(status) = 'removed' AND (coalesce(confidence, 0) < 0.98 OR phase LIKE '%duplicates') AND r / n::DOUBLE > 0.10, false) THEN 'second_opinion_' || coalesce(reason, '') ELSE reason END AS reason FROM dec JOIN g ON g.s IS NOT DISTINCT FROM dec.source_dataset")
def ratio_brake(spark, d):
    rows = _with_source(spark, d).withColumn("status", F.lower("status")).withColumn("before", F.lit(False))
    return decisions.ratio_brake(rows, ["source_dataset"], phase_limit=0.10).select("sample_id", "braked", "reason")


_TURNS = """rows AS (SELECT DISTINCT sample_id, lower(status) AS status, phase, reason, confidence, cluster_id, representative_id, evidence_level, coalesce(review_reasons, []) AS review_reasons, decided_at FROM decisions WHERE sample_id IS NOT NULL AND decided_at IS NOT NULL),
sole AS (SELECT *, min(decided_at) OVER w AS a, max(decided_at) OVER w AS z FROM (SELECT *, count(*) OVER (PARTITION BY sample_id, decided_at) AS n FROM rows) WHERE n = 1 WINDOW w AS (PARTITION BY sample_id))"""


@query(f"""WITH {_TURNS}, c AS (SELECT * FROM sole WHERE decided_at = a), n AS (SELECT * FROM sole WHERE decided_at = z AND z > a),
j AS (SELECT c.sample_id, c.status AS s, c.phase AS p, c.reason AS r, c.confidence AS f, c.cluster_id AS k, c.representative_id AS e, c.evidence_level AS l, c.review_reasons AS v, n.sample_id IS NOT NULL AS t, n.status AS ns, n.phase AS np, n.reason AS nr, n.confidence AS nf, n.cluster_id AS nk, n.representative_id AS ne, n.evidence_level AS nl, n.review_reasons AS nv FROM c LEFT JOIN n USING (sample_id)),
o AS (SELECT *, CASE WHEN s = 'review' THEN list_filter(v || CASE WHEN coalesce(r, '') <> '' THEN [r] ELSE [] END, lambda x: NOT (coalesce(p = np AND nl IN ('exact_bytes', 'exact_pixels') AND ns = 'removed', false) AND (x = coalesce(nullif(r, ''), '<none>') OR x = coalesce(nullif(nr, ''), '<none>')))) ELSE [] END || nv AS held FROM j),
u AS (SELECT *, CASE WHEN s = 'review' AND ns <> 'review' AND len(held) > 0 THEN 'review' ELSE ns END AS us FROM o)
SELECT sample_id, CASE WHEN t THEN us ELSE s END AS status, CASE WHEN t THEN np ELSE p END AS phase, CASE WHEN t THEN nr ELSE r END AS reason, CASE WHEN t THEN nf ELSE f END AS confidence, CASE WHEN t THEN nk ELSE k END AS cluster_id, CASE WHEN t THEN ne ELSE e END AS representative_id, CASE WHEN t THEN nl ELSE l END AS evidence_level,
  CASE WHEN t THEN list_sort(list_distinct(list_filter(held || CASE WHEN us = 'review' AND coalesce(nr, '') <> '' THEN [nr] ELSE [] END, lambda x: x IS NOT NULL))) ELSE v END AS review_reasons FROM u""")
def decision_merge(spark, d):
    """The last decision of each sample over its first one (moments with several different rows don't count)."""
    none = F.array().cast("array<string>")
    rows = table(spark, d, "decisions").filter("sample_id is not null and decided_at is not null").select("sample_id", F.lower("status").alias("status"), "phase", "reason", "confidence", "cluster_id", "representative_id", "evidence_level", F.coalesce("review_reasons", none).alias("review_reasons"), "decided_at").distinct()
    sole = rows.groupBy("sample_id", "decided_at").agg(F.count("*").alias("n"), *(F.first(c).alias(c) for c in rows.columns if c not in ("sample_id", "decided_at"))).filter("n = 1").drop("n")
    ends = sole.groupBy("sample_id").agg(F.min("decided_at").alias("a"), F.max("decided_at").alias("z"))
    met = sole.join(ends, "sample_id")
    first, last = met.filter("decided_at = a").drop("a", "z", "decided_at"), met.filter("decided_at = z and z > a").drop("a", "z", "decided_at")
    return decisions.merge(first, last)


@query("SELECT sample_id, (decided_at::VARCHAR)[1:19] AS at, status FROM (SELECT *, lag(status) OVER w AS b, row_number() OVER w AS n FROM (SELECT DISTINCT sample_id, decided_at, status FROM decisions WHERE sample_id IS NOT NULL AND status IS NOT NULL) WINDOW w AS (PARTITION BY sample_id ORDER BY decided_at, status)) WHERE n = 1 OR b <> status")
def status_history(spark, d):
    rows = table(spark, d, "decisions").filter("sample_id is not null and status is not null").select("sample_id", "decided_at", "status").distinct()
    return decisions.history(rows, "sample_id", "decided_at", "status").select("sample_id", F.date_format("decided_at", "yyyy-MM-dd HH:mm:ss").alias("at"), F.get_json_object("after", "$.status").alias("status"))


@query(f"WITH {_LATEST}, a AS (SELECT DISTINCT sample_id, representative_id FROM decisions WHERE representative_id <> '') SELECT a.sample_id, a.representative_id, lower(one.status) AS representative_status FROM a LEFT JOIN one ON one.sample_id = a.representative_id WHERE coalesce(lower(one.status) <> 'kept', true)")
def representative_reconcile(spark, d):
    assigned = table(spark, d, "decisions").filter("representative_id <> ''").select("sample_id", "representative_id").distinct()
    return decisions.reconcile(assigned, _latest_decisions(spark, d)).select("sample_id", "representative_id", "representative_status")


@query(f"WITH {_LATEST}, t AS (SELECT sample_id, bool_or(coalesce(list_contains(tags, 'curation_kept'), false)) AS k, bool_or(coalesce(list_contains(tags, 'curation_removed'), false)) AS r FROM samples GROUP BY 1) SELECT sample_id FROM one LEFT JOIN t USING (sample_id) WHERE lower(status) = 'review' AND NOT coalesce(k, false) AND NOT coalesce(r, false)")
def unresolved_after_tags(spark, d):
    """Reviews that are tagged neither kept nor removed."""
    tags = table(spark, d, "samples").filter("sample_id is not null").select("sample_id", F.explode("tags").alias("t")).filter("t in ('curation_kept', 'curation_removed')").groupBy("sample_id").agg(F.collect_set(F.replace("t", F.lit("curation_"), F.lit(""))).alias("tags"))
    return review.unresolved(_latest_decisions(spark, d).join(tags, "sample_id", "left"))


_CURATED = "cur AS (SELECT sample_id, lower(status) AS status, phase, representative_id FROM (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY decided_at DESC NULLS LAST, phase DESC NULLS LAST, status DESC NULLS LAST, coalesce(representative_id, '') DESC) AS n FROM (SELECT DISTINCT sample_id, decided_at, phase, status, representative_id FROM decisions WHERE sample_id IS NOT NULL)) WHERE n = 1)"


def _curated(spark, d):
    rows = table(spark, d, "decisions").select("sample_id", "decided_at", "phase", "status", F.coalesce("representative_id", F.lit("")).alias("representative_id"))
    return rel.latest(rows, "sample_id", "decided_at", "phase", "status", "representative_id").withColumn("status", F.lower("status"))


@query(f"WITH {_CURATED} SELECT c.sample_id, CASE WHEN coalesce(c.representative_id, '') = '' THEN 'no_representative' ELSE 'representative_not_kept' END AS problem FROM cur c LEFT JOIN cur r ON r.sample_id = c.representative_id WHERE c.status = 'removed' AND CASE WHEN coalesce(c.representative_id, '') = '' THEN c.phase LIKE '%duplicates' ELSE coalesce(r.status <> 'kept', true) END")
def representative_audit(spark, d):
    return review.audit_representatives(_curated(spark, d))


@query(f"WITH {_CURATED} SELECT c.sample_id, 'review' AS status, 'consistency_duplicates' AS phase, c.representative_id FROM cur c LEFT JOIN cur r ON r.sample_id = c.representative_id WHERE c.status = 'removed' AND c.representative_id <> '' AND coalesce(r.status <> 'kept', true)")
def reconcile_decisions(spark, d):
    return review.reconcile_decisions(_curated(spark, d)).select("sample_id", "status", "phase", "representative_id")


@query(f"WITH {_CURATED}, e AS (SELECT sample_id, max(evidence_level) AS level FROM decisions WHERE sample_id IS NOT NULL AND evidence_level IS NOT NULL GROUP BY 1), a AS (SELECT c.*, e.level, e.level IN ('exact_bytes', 'exact_pixels') AS exact FROM cur c JOIN e USING (sample_id) WHERE representative_id <> '' AND coalesce(status <> 'removed', true)) SELECT sample_id, CASE WHEN exact THEN 'removed' ELSE 'review' END AS status, CASE WHEN exact THEN 1.0 ELSE 0.85 END::DOUBLE AS confidence, CASE WHEN exact THEN 'duplicate_of:' || representative_id ELSE 'potential_duplicate_requires_human_review' END AS keep_reason, level AS evidence_level FROM a WHERE coalesce(phase <> 'human_review', true)")
def duplicate_decisions(spark, d):
    """What recorded representatives and evidence would decide."""
    levels = table(spark, d, "decisions").filter("sample_id is not null and evidence_level is not null").groupBy("sample_id").agg(F.max("evidence_level").alias("level"))
    now = _curated(spark, d)
    assigned = now.filter("representative_id <> ''").select("sample_id", "representative_id").join(levels, "sample_id").withColumn("conflict", F.lit(False))
    return review.duplicate_decisions(assigned, now, "exact_duplicates", "duplicate").select("sample_id", "status", "confidence", "keep_reason", "evidence_level")


# splits and balance


@query("SELECT capture_group, list_sort(list(DISTINCT source_split) FILTER (source_split IS NOT NULL)) AS splits FROM samples WHERE capture_group IS NOT NULL GROUP BY 1 HAVING count(DISTINCT source_split) > 1")
def split_audit(spark, d):
    return splits.split_groups(table(spark, d, "samples").withColumnRenamed("source_split", "split"), "capture_group")


@query(f"WITH {_PAIRS}, s AS (SELECT sample_id, min(source_split) AS split FROM samples WHERE sample_id IS NOT NULL GROUP BY 1) SELECT p.a AS left, p.b AS right, x.split AS left_split, y.split AS right_split FROM (SELECT DISTINCT a, b FROM pairs WHERE level IN ('exact_bytes', 'exact_pixels', 'verified_visual', 'human_confirmed')) p JOIN s x ON x.sample_id = p.a JOIN s y ON y.sample_id = p.b WHERE x.split <> y.split")
def crossing_pairs(spark, d):
    pairs = table(spark, d, "duplicate_links").filter("left_id <> right_id").filter(F.col("level").isin(*duplicates.CONFIRMED)).select(F.least("left_id", "right_id").alias("left"), F.greatest("left_id", "right_id").alias("right")).distinct()
    of = table(spark, d, "samples").filter("sample_id is not null").groupBy("sample_id").agg(F.min("source_split").alias("split"))
    return splits.crossing_pairs(pairs, of).select("left", "right", "left_split", "right_split")


@query()
def group_allocation(spark, d):
    samples = table(spark, d, "samples")
    rows = samples.join(stage(duplicates.all_families(samples, table(spark, d, "duplicate_links")), "families"), "sample_id").select("group_id", F.col("source_label").alias("label"))
    return splits.allocate(splits.group_table(rows), {"train": 0.8, "val": 0.1, "test": 0.1})


@query("SELECT coalesce(source_label, '__unlabeled__') AS label, count(*) AS rows, true AS balanced FROM samples WHERE sample_id IS NOT NULL GROUP BY 1 UNION ALL SELECT NULL, 0, true")
def allocation_balance(spark, d):
    """Whether each split of group_allocation has its part of a label (within 1 % of its rows, two groups
    and a row), and (label null) that no family was split."""
    samples = table(spark, d, "samples")
    families = stage(duplicates.all_families(samples, table(spark, d, "duplicate_links")), "families")
    rows = stage(samples.join(families, "sample_id").select("sample_id", "group_id", F.col("source_label").alias("label")), "rows")
    shares = {"train": 0.8, "val": 0.1, "test": 0.1}
    got = stage(splits.allocate(splits.group_table(rows), shares), "allocation")
    met = rows.join(got, "group_id").select("sample_id", "group_id", F.coalesce("label", F.lit("__unlabeled__")).alias("label"), "split")
    per = met.groupBy("label", "group_id", "split").agg(F.count("*").alias("n"))
    sums = per.groupBy("label").agg(F.sum("n").alias("rows"), F.max("n").alias("most"), *(F.sum(F.when(F.col("split") == k, F.col("n")).otherwise(0)).alias(k) for k in shares))
    fine = F.lit(True)
    for k, p in shares.items():
        fine = fine & (F.abs(F.col(k) - p * F.col("rows")) <= 0.01 * F.col("rows") + 1 + 2 * F.col("most"))
    torn = splits.split_groups(met, "group_id").agg(F.lit(None).cast("string").alias("label"), F.count("*").alias("rows"), (F.count("*") == 0).alias("balanced"))
    return sums.select("label", "rows", fine.alias("balanced")).unionByName(torn)


@query("SELECT sample_id, CASE regexp_extract(lower(filepath), '/(train|test|valid|val|validation)/', 1) WHEN 'validation' THEN 'valid' ELSE regexp_extract(lower(filepath), '/(train|test|valid|val|validation)/', 1) END AS split FROM samples")
def split_from_path(spark, d):
    return table(spark, d, "samples").select("sample_id", tx.split_of_path(F.col("filepath")).alias("split"))


@query(f"WITH {_TARGETS} SELECT label, sum(least(2000, greatest(0, a - rows)))::BIGINT AS rows FROM c, t WHERE a > rows GROUP BY 1")
def oversample_rows(spark, d):
    e = table(spark, d, "embeddings").withColumn("label", F.col("label"))
    missing = agg.balance_targets(e, "label").select("label", F.col("missing_max").alias("missing"))
    return balance.oversample_plan(e, missing, "label", "vec_id").groupBy("label").agg(F.count("*").alias("rows"))


# labels


@query(r"SELECT p_partkey, trim(regexp_replace(lower(regexp_replace(p_name, '[_-]', ' ', 'g')), '\s+', ' ', 'g')) AS plain, replace(trim(regexp_replace(lower(regexp_replace(p_name, '[_-]', ' ', 'g')), '\s+', ' ', 'g')), ' ', '_') AS label, trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '_', 'g'), '_') AS slug FROM part")
def label_normal_forms(spark, d):
    n = F.col("p_name")
    return table(spark, d, "part").select("p_partkey", tx.normal_text(n).alias("plain"), tx.normal_label(n).alias("label"), tx.slug(n).alias("slug"))


_ASCII = "coalesce(nullif(trim(regexp_replace(regexp_replace(lower(strip_accents(trim({}))), '[^\\x00-\\x7F]', '', 'g'), '[^a-z0-9]+', '_', 'g'), '_'), ''), 'unlabeled')"
_HEALTHY, _SICK = (str(list(t)) for t in (tx.HEALTHY_TOKENS, tx.DISEASE_TOKENS))


@query(f"""WITH p AS (SELECT sample_id, source_dataset, {_ASCII.format('source_label')} AS plain FROM samples), t AS (SELECT *, string_split(plain, '_') AS w FROM p),
h AS (SELECT source_dataset, bool_or(list_has_any(w, {_HEALTHY})) AS peer FROM t GROUP BY 1)
SELECT sample_id, plain, CASE WHEN list_has_any(w, {_HEALTHY}) OR regexp_matches(plain, 'healthy|sano|saglam') THEN 'sano' WHEN list_has_any(w, {_SICK}) OR regexp_matches(plain, 'enferm|diseas|rot|spot|blight|rust') THEN 'enfermo' WHEN peer THEN 'enfermo' ELSE plain END AS coarse
FROM t LEFT JOIN h ON h.source_dataset IS NOT DISTINCT FROM t.source_dataset""")
def coarse_labels(spark, d):
    """With the other classes of its source as peers."""
    s = table(spark, d, "samples").select("sample_id", "source_dataset", "source_label")
    peers = s.groupBy("source_dataset").agg(F.max(tx.healthy_tokens(F.col("source_label"))).alias("peer"))
    met = s.join(peers.withColumnRenamed("source_dataset", "_s"), F.col("source_dataset").eqNullSafe(F.col("_s")), "left")
    return met.select("sample_id", tx.ascii_label(F.col("source_label")).alias("plain"), tx.coarse_label(F.col("source_label"), F.col("peer")).alias("coarse"))


_NORMAL = "replace(lower(trim(regexp_replace(regexp_replace(strip_accents({}), '[_-]', ' ', 'g'), '\\s+', ' ', 'g'))), ' ', '_')"


@query(f"""WITH o AS (SELECT name AS raw, name AS canonical FROM ontology WHERE field = 'disease' UNION ALL SELECT unnest(aliases), name FROM ontology WHERE field = 'disease'), k AS (SELECT {_NORMAL.format('raw')} AS key, min(canonical) AS canonical FROM o WHERE raw IS NOT NULL GROUP BY 1)
SELECT sample_id, source_label, coalesce(canonical, {_NORMAL.format('source_label')}) AS canonical FROM samples LEFT JOIN k ON k.key = {_NORMAL.format('source_label')}""")
def ontology_labels(spark, d):
    o = table(spark, d, "ontology").filter("field = 'disease'")
    raw = o.select(F.col("name").alias("raw"), F.col("name").alias("canonical")).unionByName(o.select(F.explode("aliases").alias("raw"), F.col("name").alias("canonical")))
    return labels.apply_ontology(table(spark, d, "samples").select("sample_id", "source_label"), raw, "source_label")


@query()
def label_names(spark, d):
    """Raw labels with the names that merging variants gives them."""
    return labels.label_phase(table(spark, d, "samples").select("sample_id", "source_dataset", "source_label"))[1]


@query()
def label_suggestions(spark, d):
    own = table(spark, d, "samples").filter("source_label is not null").select(tx.ascii_label(F.col("source_label")).alias("label")).groupBy("label").agg(F.count("*").alias("rows"))
    return labels.label_pairs(own, "label", "rows")


@query("SELECT a.r_name AS left, b.n_name AS right, round(len(list_intersect(list_distinct(string_split_regex(a.r_name, '[_ ]+')), list_distinct(string_split_regex(b.n_name, '[_ ]+')))) / len(list_distinct(string_split_regex(a.r_name, '[_ ]+') || string_split_regex(b.n_name, '[_ ]+')))::DOUBLE, 6) AS overlap FROM region a JOIN nation b ON a.r_regionkey = b.n_regionkey")
def token_overlap(spark, d):
    r, n = table(spark, d, "region"), table(spark, d, "nation")
    return r.join(n, r.r_regionkey == n.n_regionkey).select(F.col("r_name").alias("left"), F.col("n_name").alias("right"), F.round(tx.token_jaccard(F.col("r_name"), F.col("n_name")), 6).alias("overlap"))


# exports


@query(r"SELECT s.sample_id, s.filepath, s.source_split, s.source_label, s.sample_id || lower(regexp_extract(s.filepath, '(\.[^./]+)$', 1)) AS export_name FROM samples s")
def manifest_rows(spark, d):
    return export.manifest(table(spark, d, "samples")).select("sample_id", "filepath", "source_split", "source_label", "export_name")


@query("SELECT DISTINCT lower(asset_sha256) || '  ' || q.sample_id || lower(regexp_extract(s.filepath, '(\\.[^./]+)$', 1)) AS line FROM quality_metrics q JOIN (SELECT sample_id, min(filepath) AS filepath FROM samples GROUP BY 1) s USING (sample_id) WHERE asset_sha256 <> ''")
def checksum_lines(spark, d):
    names = table(spark, d, "samples").groupBy("sample_id").agg(F.min("filepath").alias("filepath"))
    return export.checksum_lines(table(spark, d, "quality_metrics").filter("asset_sha256 <> ''").join(names, "sample_id")).distinct()


@query("WITH c AS (SELECT l_shipmode, row_number() OVER (ORDER BY l_shipmode) - 1 AS k FROM (SELECT DISTINCT l_returnflag AS l_shipmode FROM lineitem)) SELECT l_orderkey::VARCHAR AS sample_id, string_agg(printf('%d %.6f %.6f %.6f %.6f', k, l_discount + 0.1, l_tax + 0.05, 0.2, 0.1), chr(10) ORDER BY k, printf('%d %.6f %.6f %.6f %.6f', k, l_discount + 0.1, l_tax + 0.05, 0.2, 0.1)) AS text FROM lineitem JOIN c ON c.l_shipmode = l_returnflag GROUP BY 1")
def yolo_label_text(spark, d):
    boxes = table(spark, d, "lineitem").select(F.col("l_orderkey").cast("string").alias("sample_id"), F.col("l_returnflag").alias("label"), F.array(F.col("l_discount"), F.col("l_tax"), F.lit(0.2), F.lit(0.1)).alias("box"))
    return export.yolo_labels(boxes, export.class_ids(boxes, "label"))


@query()
def coco_annotations(spark, d):
    boxes = table(spark, d, "lineitem").select(F.col("l_orderkey").cast("string").alias("sample_id"), F.col("l_returnflag").alias("label"), F.array(F.col("l_discount"), F.col("l_tax"), F.lit(0.2), F.lit(0.1)).alias("box"), F.lit(640).alias("width"), F.lit(480).alias("height"))
    return export.coco_rows(boxes, export.class_ids(boxes, "label"))


@query("SELECT label_id, filename, split, disease, CASE WHEN condition IS NOT NULL THEN condition WHEN lower(disease) IN ('sano', 'healthy') THEN 'sano' ELSE 'enfermo' END AS condition FROM labels")
def clean_labels(spark, d):
    return table(spark, d, "labels").select("label_id", "filename", "split", "disease", export.condition_of(F.col("condition"), F.lit(None).cast("string"), F.col("disease")).alias("condition"))


_SUFFIX = r"lower(regexp_extract(filepath, '(\.[^./]+)$', 1))"


@query(f"""SELECT sample_id AS id, 'images/' || sample_id || {_SUFFIX} AS filepath, coalesce(filepath, '') AS source_path, coalesce(source_dataset, '') AS source_dataset, coalesce(source_split, '') AS source_split, '' AS assigned_split, coalesce(source_label, '') AS source_label, '' AS normalized_label, coalesce(task_type, 'unlabeled') AS task_type, '' AS normalized_labels, '' AS asset_sha256, '0' AS size_bytes, 'false' AS detection_exported, '' AS family_id, '' AS split_group_id, '' AS representative_id, '' AS curation_reason, '' AS deduplication_version, 'unknown' AS source_version, 'unknown' AS source_license FROM samples""")
def release_manifest(spark, d):
    """All twenty columns of a release's manifest."""
    return release.manifest(table(spark, d, "samples"))


_NAMED = "n AS (SELECT list_extract(string_split(filename, '/'), -1) AS filename, coalesce(nullif(split, ''), 'train') AS split, CASE WHEN coalesce(nullif(disease, ''), 'objeto') = 'rust_mite' THEN 'aculus_olearius' ELSE coalesce(nullif(disease, ''), 'objeto') END AS disease, coalesce(task, 'detection') AS task, source_dataset AS s FROM labels)"
_PUBLIC = f"{_NAMED}, p AS (SELECT filename, split, disease, CASE WHEN disease IN ('olivo', 'olive_tree', 'crown') THEN 'olivo' WHEN disease IN {release.HEALTHY} THEN 'sano' WHEN disease IN {release.DAMAGED} THEN 'dañado' ELSE 'enfermo' END AS condition, task, coalesce(r.homepage, n.s) AS source_dataset, coalesce(r.license, '') AS source_url FROM n LEFT JOIN sources r ON r.source_dataset = n.s)"


def _public(spark, d):
    rows = table(spark, d, "labels").select(F.col("filename").alias("filepath"), F.col("split").alias("assigned_split"), F.col("disease").alias("normalized_label"), F.col("task").alias("task_type"), "source_dataset")
    registry = table(spark, d, "sources").select("source_dataset", F.col("homepage").alias("title"), F.col("license").alias("url"))
    return release.clean_labels(rows, registry)


@query(f"WITH {_PUBLIC} SELECT filename, split, disease, condition, task, source_dataset, source_url FROM p")
def release_labels(spark, d):
    """The seven columns of the public label list."""
    return _public(spark, d)


@query(f"WITH {_PUBLIC} SELECT disease, min(condition) AS condition, count(*) AS images FROM p GROUP BY 1")
def release_classes(spark, d):
    return release.release_counts(_public(spark, d))[0]


@query(f"WITH {_PUBLIC} SELECT split, count(*) AS images, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM p), 1) AS percent FROM p GROUP BY 1")
def release_splits(spark, d):
    return release.release_counts(_public(spark, d))[1]


@query("SELECT count(*) FILTER (lower(task_type) LIKE '%detection%') AS detection, count(*) FILTER (lower(task_type) LIKE '%classification%') AS classification FROM samples")
def task_counters(spark, d):
    """What decides the layout of a release."""
    task = F.lower("task_type")
    return table(spark, d, "samples").agg(F.count_if(F.contains(task, F.lit("detection"))).alias("detection"), F.count_if(F.contains(task, F.lit("classification"))).alias("classification"))


@query("SELECT p_partkey, row_number() OVER (ORDER BY p_brand, p_partkey) AS id FROM part")
def numbered_rows(spark, d):
    """Consecutive numbers in an order, without one task that holds all rows."""
    return rel.numbered(table(spark, d, "part").select("p_partkey", "p_brand"), "p_brand", "p_partkey").select("p_partkey", "id")


_BOXED = "b AS (SELECT l_orderkey, l_linenumber, l_returnflag, l_discount, l_tax, l_shipdate, CASE l_orderkey % 3 WHEN 0 THEN 'train' WHEN 1 THEN 'val' ELSE 'test' END AS split FROM lineitem), i AS (SELECT *, row_number() OVER (ORDER BY split, l_orderkey::VARCHAR) AS image_id FROM (SELECT DISTINCT l_orderkey, split FROM b)), c AS (SELECT l_returnflag, row_number() OVER (ORDER BY l_returnflag) - 1 AS k FROM (SELECT DISTINCT l_returnflag FROM lineitem)), a AS (SELECT i.split, row_number() OVER (ORDER BY i.split, image_id, l_linenumber, l_returnflag, l_discount, l_tax) AS id, image_id, k, l_discount * 640 AS x, l_tax * 480 AS y FROM b JOIN i USING (l_orderkey) JOIN c USING (l_returnflag))"


@query(f"WITH {_BOXED} SELECT split, 'annotations' AS part, id, image_id, k AS category_id, round(x, 3) AS x, round(y, 3) AS y FROM a UNION ALL SELECT split, 'images', image_id, NULL, NULL, NULL, NULL FROM i UNION ALL SELECT split, 'categories', k, NULL, NULL, NULL, NULL FROM c, (SELECT DISTINCT split FROM i)")
def coco_entries(spark, d):
    """The entries of COCO documents for three splits, read back from their JSON."""
    split = F.when(F.col("l_orderkey") % 3 == 0, "train").when(F.col("l_orderkey") % 3 == 1, "val").otherwise("test")
    lines = table(spark, d, "lineitem").select(F.col("l_orderkey").cast("string").alias("sample_id"), split.alias("assigned_split"), F.struct("l_linenumber", F.col("l_returnflag").alias("label"), F.col("l_discount").alias("x"), F.col("l_tax").alias("y")).alias("b"))
    own = lines.groupBy("sample_id", "assigned_split").agg(F.array_sort(F.collect_list("b")).alias("bs"))
    boxes = F.transform("bs", lambda b: F.struct(b["label"].alias("label"), F.array(b["x"], b["y"], F.lit(0.2), F.lit(0.1)).alias("bounding_box")))
    samples = own.select("sample_id", "assigned_split", F.concat("sample_id", F.lit(".jpg")).alias("filepath"), F.lit(640).alias("width"), F.lit(480).alias("height"), boxes.alias("boxes"))
    out = release.coco_documents(samples, export.class_ids(lines.select(F.col("b.label").alias("label")), "label"))
    j = F.from_json("text", "struct<image_id:bigint,category_id:bigint,bbox:array<double>>")
    return out.withColumn("j", j).select("split", "part", "id", "j.image_id", "j.category_id", F.get("j.bbox", 0).alias("x"), F.get("j.bbox", 1).alias("y"))


@query("SELECT s.sample_id, s.source_dataset FROM (SELECT DISTINCT sample_id, source_dataset FROM samples WHERE sample_id IS NOT NULL) s WHERE NOT EXISTS (SELECT 1 FROM quality_metrics q WHERE q.sample_id = s.sample_id AND (q.is_corrupted OR q.processing_error)) AND NOT EXISTS (SELECT 1 FROM decisions d WHERE d.sample_id = s.sample_id AND lower(d.status) = 'removed')")
def eligible_samples(spark, d):
    """Samples that nothing speaks against: never corrupted, failed or removed."""
    bad = table(spark, d, "quality_metrics").filter("is_corrupted or processing_error").select("sample_id").unionByName(table(spark, d, "decisions").filter("lower(status) = 'removed'").select("sample_id"))
    return rel.drop_ids(table(spark, d, "samples").filter("sample_id is not null").select("sample_id", "source_dataset").distinct(), bad)


@query("SELECT least(a, b) AS \"left\", greatest(a, b) AS \"right\", list_sort(list(DISTINCT src)) AS sources FROM (SELECT left_id AS a, right_id AS b, 'links' AS src FROM duplicate_links WHERE left_id <> right_id UNION ALL SELECT least(x.sample_id, y.s), greatest(x.sample_id, y.s), 'digest' FROM quality_metrics x JOIN (SELECT lower(trim(asset_sha256)) AS g, min(sample_id) AS s FROM quality_metrics WHERE trim(asset_sha256) <> '' AND sample_id IS NOT NULL GROUP BY 1) y ON y.g = lower(trim(x.asset_sha256)) AND x.sample_id <> y.s) GROUP BY 1, 2")
def candidate_union(spark, d):
    """Unordered pairs of several sources of candidates, each once, with where they came from."""
    links = table(spark, d, "duplicate_links").filter("left_id <> right_id").select(F.least("left_id", "right_id").alias("left"), F.greatest("left_id", "right_id").alias("right"), F.lit("links").alias("src"))
    same = duplicates.exact_edges(table(spark, d, "quality_metrics")).select(F.least("left", "right").alias("left"), F.greatest("left", "right").alias("right"), F.lit("digest").alias("src"))
    return links.unionByName(same).groupBy("left", "right").agg(F.array_sort(F.collect_set("src")).alias("sources"))


@query("WITH c AS (SELECT label, count(*) AS n FROM embeddings WHERE label IS NOT NULL GROUP BY 1), t AS (SELECT max(n) AS a FROM c) SELECT label, n + least(2000, greatest(0, a - n)) AS rows, least(2000, greatest(0, a - n)) AS synthetic FROM c, t")
def balanced_rows(spark, d):
    """Classes after synthetic rows were appended."""
    e = table(spark, d, "embeddings").filter("label is not null")
    missing = agg.balance_targets(e, "label").select("label", F.col("missing_max").alias("missing"))
    new = balance.oversample_plan(e, missing, "label", "vec_id").select("label", F.lit(True).alias("is_synthetic"))
    both = e.select("label", F.lit(False).alias("is_synthetic")).unionByName(new)
    return both.groupBy("label").agg(F.count("*").alias("rows"), F.count_if("is_synthetic").alias("synthetic"))


_REPORT = ("sample_id", "filepath", "source_dataset", "source_split", "source_label", "task_type")


@query(f"WITH {_LATEST}, m AS (SELECT sample_id, arg_max(q, (measured_at IS NOT NULL, measured_at)) AS q FROM (SELECT sample_id, measured_at, struct_pack(w := width, h := height) AS q, count(*) OVER (PARTITION BY sample_id, measured_at) AS k FROM quality_metrics WHERE sample_id IS NOT NULL AND measured_at IS NOT NULL) WHERE k = 1 GROUP BY 1) SELECT s.sample_id, s.filepath, s.source_dataset, s.source_split, s.source_label, s.task_type, lower(one.status) AS status, one.phase, one.reason, one.confidence, m.q.w AS width, m.q.h AS height FROM samples s LEFT JOIN one USING (sample_id) LEFT JOIN m USING (sample_id)")
def report_rows(spark, d):
    """What a report shows of each sample: identity, decision and measures."""
    q = table(spark, d, "quality_metrics").filter("sample_id is not null and measured_at is not null")
    sole = q.groupBy("sample_id", "measured_at").agg(F.count("*").alias("k"), F.first(F.struct("width", "height")).alias("q")).filter("k = 1")
    measured = sole.groupBy("sample_id").agg(F.max_by("q", "measured_at").alias("q"))
    own = table(spark, d, "samples").select(*_REPORT).join(_latest_decisions(spark, d).drop("decided_at"), "sample_id", "left").join(measured, "sample_id", "left")
    return own.select(*_REPORT, F.lower("status").alias("status"), "phase", "reason", "confidence", "q.width", "q.height")


@query("SELECT sample_id, confidence FROM (SELECT DISTINCT sample_id, confidence FROM decisions WHERE sample_id IS NOT NULL AND confidence IS NOT NULL) ORDER BY confidence DESC, sample_id")
def sorted_decisions(spark, d):
    return table(spark, d, "decisions").filter("sample_id is not null and confidence is not null").select("sample_id", "confidence").distinct().orderBy(F.desc("confidence"), "sample_id")


@query("SELECT sample_id, sha256(to_json([coalesce(lower(digest), ''), coalesce(source_dataset, ''), coalesce(filepath, '')])::VARCHAR) AS stable_id FROM (SELECT DISTINCT sample_id, source_dataset, filepath FROM samples WHERE sample_id IS NOT NULL) LEFT JOIN (SELECT sample_id, min(lower(trim(asset_sha256))) AS digest FROM quality_metrics WHERE trim(asset_sha256) <> '' GROUP BY 1) USING (sample_id)")
def stable_identities(spark, d):
    """A name of each asset that doesn't depend on when it was stored."""
    digests = table(spark, d, "quality_metrics").filter(F.trim("asset_sha256") != "").groupBy("sample_id").agg(F.min(F.lower(F.trim("asset_sha256"))).alias("digest"))
    own = table(spark, d, "samples").filter("sample_id is not null").select("sample_id", "source_dataset", "filepath").distinct().join(digests, "sample_id", "left")
    return own.select("sample_id", duplicates.stable_identity(F.col("digest"), F.col("source_dataset"), F.col("filepath")).alias("stable_id"))


_PATHS = "p AS (SELECT sample_id, list_filter(string_split(filepath, '/'), lambda x: x <> '') AS w FROM samples WHERE filepath IS NOT NULL), a AS (SELECT *, coalesce(list_position(list_transform(w, lambda x: lower(x) IN ('train', 'test', 'valid', 'val', 'validation')), true), 0) AS k FROM p), o AS (SELECT sample_id, CASE WHEN k > 0 AND k + 1 < len(w) THEN w[k + 1] WHEN k = 0 AND len(w) >= 3 THEN w[-2] END AS label FROM a)"


@query(f"WITH {_PATHS} SELECT sample_id, CASE WHEN lower(label) NOT IN ('images', 'img', 'data', 'raw', 'labels', 'annotations', 'jpegimages', 'train', 'test', 'valid', 'val', 'validation') THEN label END AS label FROM o")
def label_from_path(spark, d):
    return table(spark, d, "samples").filter("filepath is not null").select("sample_id", tx.label_of_path(F.col("filepath")).alias("label"))


@query("WITH g AS (SELECT l_orderkey, list_sort(list(DISTINCT replace(lower(l_returnflag), ' ', '_')) FILTER (l_discount + l_tax <= 1 + 1e-9 AND l_tax > 0)) AS labels, count(*) FILTER (l_discount + l_tax <= 1 + 1e-9 AND l_tax > 0) AS good, count(*) AS n FROM lineitem GROUP BY 1) SELECT l_orderkey, coalesce(labels, []) AS labels, CASE WHEN good > 0 THEN ['detection'] ELSE [] END AS tasks, CASE WHEN n > good THEN ['invalid_bbox'] ELSE [] END || CASE WHEN len(coalesce(labels, [])) = 0 THEN ['no_label'] ELSE [] END AS issues FROM g")
def canonical_annotations(spark, d):
    """Labels, tasks and faults of rows with boxes and no label of their own."""
    boxes = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct(tx.normal_label(F.col("l_returnflag")).alias("label"), F.array(F.col("l_discount"), F.lit(0.0), F.col("l_tax"), F.lit(0.5)).alias("bounding_box"))).alias("b"))
    names, tasks, issues = labels.canonical_annotations(F.col("b"), F.lit(None).cast("string"))
    return boxes.select("l_orderkey", names.alias("labels"), tasks.alias("tasks"), issues.alias("issues"))
