"""File integrity of many archives at once: manifests against actual contents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverlode.functions import dates, digest, money, paths
from silverlode.sources import manifests

# Per-file results, archive statuses and exit codes.
OK, FAIL, MISSING, EXTRA = "OK", "FAIL", "MISSING", "EXTRA"
STATUS_BY_EXIT = {0: "PASS", 3: "FAIL"}
OTHER_STATUS = "ERROR"
MANIFEST_EXTENSION = ".hash"
SUMMARY_REGEX = r"OK=(\d+) FAIL=(\d+) MISSING=(\d+) EXTRA=(\d+)"


def generate_manifest(members: DataFrame, algorithm: str = "sha512") -> DataFrame:
    """(archive, path, actual): the digest of every file."""
    return members.select("archive", paths.unix_path("path").alias("path"), digest.digest("content", algorithm).alias("actual"))


def manifest_text(manifest: DataFrame, root: Column | None = None) -> DataFrame:
    """Manifest lines: a ``# Root:`` header per archive (its name, or ``root``), then
    ``digest|path`` with backslash separators."""
    windows = F.replace("path", F.lit("/"), F.lit("\\"))
    named = manifest.select("archive", (F.col("archive") if root is None else root).alias("root")).distinct()
    headers = named.select("archive", F.concat(F.lit("# Root: "), "root").alias("line"))
    return headers.union(manifest.select("archive", F.concat("actual", F.lit("|"), windows).alias("line")))


def validate(entries: DataFrame, actual: DataFrame, ignore_case: bool = False) -> DataFrame:
    """OK, FAIL, MISSING or EXTRA per listed or present file.

    With ``ignore_case`` paths differ only by more than case, as on Windows.

    ``entries`` is (archive, path, expected), ``actual`` (archive, path, actual).
    Repeated manifest lines are counted once.  Manifests themselves are never
    EXTRA.  The join key is the single file, so a huge archive spreads out.
    """
    key = F.lower("path") if ignore_case else F.col("path")
    listed = entries.groupBy("archive", key.alias("_key"), "expected").agg(F.min("path").alias("_listed"))
    found = actual.where(~paths.has_extension("path", MANIFEST_EXTENSION)).withColumn("_key", key)
    joined = listed.join(found, ["archive", "_key"], "full_outer").withColumn("path", F.coalesce("path", "_listed"))
    result = (
        F.when(F.col("expected").isNull(), F.lit(EXTRA))
        .when(F.col("actual").isNull(), F.lit(MISSING))
        .when(F.col("expected") == F.col("actual"), F.lit(OK))
        .otherwise(F.lit(FAIL))
    )
    return joined.select("archive", "path", "expected", "actual", result.alias("result"))


def exit_status(exit_code: Column) -> Column:
    known = [F.when(exit_code == code, F.lit(status)) for code, status in STATUS_BY_EXIT.items()]
    return F.coalesce(*known, F.lit(OTHER_STATUS))


def summary_line() -> Column:
    counts = ("ok_count", "fail_count", "missing_count", "extra_count")
    return F.format_string("SUMMARY: OK=%d FAIL=%d MISSING=%d EXTRA=%d", *counts)


def summarise(results: DataFrame) -> DataFrame:
    """Counts, exit code, status and summary line per archive."""
    g = results.groupBy("archive").agg(
        *[F.count_if(F.col("result") == r).alias(f"{r.lower()}_count") for r in (OK, FAIL, MISSING, EXTRA)]
    )
    bad = F.col("fail_count") + F.col("missing_count") + F.col("extra_count")
    code = F.when(F.col("ok_count") + bad == 0, F.lit(2)).when(bad == 0, F.lit(0)).otherwise(F.lit(3))
    return g.withColumns({"exit_code": code, "summary": summary_line()}).withColumn("status", exit_status(F.col("exit_code")))


def validate_archives(
    archives: DataFrame, members: DataFrame, inside: DataFrame, beside: DataFrame, ignore_case: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Results per file and summary per archive of a whole delivery.

    ``archives`` is (archive), ``members`` (archive, path, actual) and the manifests
    (archive, manifest_path, line), those inside the archives and those beside them.  An
    archive's own manifest is preferred.  A folder that wraps all of an archive's files
    is left out of their paths.  An archive without a manifest, or whose manifest names
    no root, is an ERROR with exit code 2, and its files are not compared; empty
    archives have a summary too.
    """
    chosen = discover_manifests(inside.select("archive", "manifest_path"), beside.select("archive", "manifest_path"))
    from_inside = inside.withColumn("found", F.lit("inside"))
    lines = from_inside.unionByName(beside.withColumn("found", F.lit("sibling")))
    lines = lines.join(chosen, ["archive", "manifest_path", "found"])
    usable = manifests.parse_roots(lines).select("archive")
    files = members.where(~paths.has_extension("path", MANIFEST_EXTENSION))
    files = strip_roots(files, wrapper_roots(files)).join(usable, "archive", "left_semi")
    entries = manifests.parse_entries(lines).join(usable, "archive", "left_semi")
    results = validate(entries, files.select("archive", "path", "actual"), ignore_case)
    counted = summarise(results).drop("exit_code", "status", "summary")
    known = usable.withColumn("_usable", F.lit(True))
    every = archives.select("archive").distinct().join(known, "archive", "left").join(counted, "archive", "left")
    counts = ["ok_count", "fail_count", "missing_count", "extra_count"]
    every = every.withColumns({c: F.coalesce(c, F.lit(0)) for c in counts})
    bad = F.col("fail_count") + F.col("missing_count") + F.col("extra_count")
    code = F.when(F.col("_usable").isNull(), 2).when(bad == 0, 0).otherwise(3)
    every = every.withColumns({"exit_code": code, "summary": summary_line()}).drop("_usable")
    return results, every.withColumn("status", exit_status(F.col("exit_code")))


def parse_summary(lines: DataFrame, column: str = "summary") -> DataFrame:
    """Counts read back from summary lines."""
    names = ["ok_count", "fail_count", "missing_count", "extra_count"]
    parsed = [F.regexp_extract(column, SUMMARY_REGEX, i).try_cast("long").alias(n) for i, n in enumerate(names, 1)]
    return lines.select("archive", *parsed)


def discover_manifests(inside: DataFrame, beside: DataFrame) -> DataFrame:
    """The manifest to use per archive: one inside it first, else the sibling file.

    Both inputs are (archive, manifest_path); several inside count by path order.
    """
    both = inside.select("archive", F.lit(0).alias("p"), "manifest_path").unionByName(
        beside.select("archive", F.lit(1).alias("p"), "manifest_path")
    )
    best = F.min(F.struct("p", "manifest_path"))
    return both.groupBy("archive").agg(best.alias("b")).select(
        "archive", F.col("b.manifest_path").alias("manifest_path"),
        F.when(F.col("b.p") == 0, F.lit("inside")).otherwise(F.lit("sibling")).alias("found"),
    )


def wrapper_roots(members: DataFrame) -> DataFrame:
    """(archive, root): the single top folder that wraps all files, else empty."""
    top = paths.top_segment("path")
    at_root = ~F.col("path").contains("/")
    g = members.groupBy("archive").agg(
        F.min(top).alias("first_top"), F.max(top).alias("last_top"), F.count_if(at_root).alias("root_files")
    )
    wrapped = (F.col("first_top") == F.col("last_top")) & (F.col("root_files") == 0)
    return g.select("archive", F.when(wrapped, F.col("first_top")).otherwise(F.lit("")).alias("root"))


def strip_roots(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """``rows`` with each archive's root folder removed from ``path``."""
    r = roots.select(F.col("archive").alias("_a"), F.col("root").alias("_root"))
    joined = rows.join(r, F.col("archive") == F.col("_a"), "left")
    stripped = F.when(F.coalesce("_root", F.lit("")) != "", paths.strip_root("path", "_root")).otherwise(F.col("path"))
    return joined.withColumn("path", stripped).drop("_a", "_root")


def verify_digest(files: DataFrame) -> DataFrame:
    """Whole-file check against ``expected``; its length tells the algorithm."""
    actual = digest.digest_like("content", F.trim("expected"))
    verdict = F.when(actual.isNull(), F.lit("UNKNOWN_ALGORITHM")).when(
        actual == F.lower(F.trim("expected")), F.lit(OK)
    ).otherwise(F.lit(FAIL))
    return files.select("archive", "path", F.length(F.trim("expected")).alias("digest_length"), verdict.alias("result"))


# ---- validation history --------------------------------------------------------------


def history_rows(summaries: DataFrame, validated_at: Column) -> DataFrame:
    return summaries.select(
        "archive", validated_at.alias("validated_at"), "status", "ok_count", "fail_count", "missing_count", "extra_count"
    )


def daily_summary(history: DataFrame) -> DataFrame:
    return history.groupBy(F.col("validated_at").cast("date").alias("validation_day")).agg(
        F.count("*").alias("total"),
        F.count_if(F.col("status") == "PASS").alias("passed"),
        F.count_if(F.col("status") == "FAIL").alias("failed"),
        money.percent(F.count_if(F.col("status") == "PASS"), F.count("*")).alias("pass_pct"),
    )


def recent_failures(history: DataFrame, as_of: str, days: int, n: int) -> DataFrame:
    recent = history.where((F.col("status") != "PASS") & (F.col("validated_at") >= F.date_sub(dates.day(as_of), days)))
    rest = [c for c in history.columns if c not in ("validated_at", "archive")]
    return recent.orderBy(F.col("validated_at").desc(), "archive", *rest).limit(n)


def latest_status(history: DataFrame) -> DataFrame:
    """Go or no-go per archive by its newest validation; at the same moment the worst counts."""
    newest = F.max(F.struct("validated_at", (F.col("status") != "PASS").alias("bad"), "status"))
    g = history.groupBy("archive").agg(newest.alias("b"))
    return g.select(
        "archive", F.col("b.validated_at").alias("validated_at"), F.col("b.status").alias("status"),
        (F.col("b.status") == "PASS").alias("go"),
    )


def destination(summaries: DataFrame) -> DataFrame:
    """PASS archives go to staging, all others to quarantine."""
    zone = F.when(F.col("status") == "PASS", F.lit("staging")).otherwise(F.lit("quarantine"))
    return summaries.select("archive", "status", zone.alias("zone"))


def route_drops(drops: DataFrame) -> DataFrame:
    """Company and type read from archive names; names that do not parse are errors."""
    company, kind = paths.routed_company("file_name"), paths.routed_type("file_name")
    return drops.select(
        "file_name",
        company.alias("company"),
        kind.alias("file_type"),
        F.when(company.isNull(), F.lit("UNROUTABLE")).otherwise(F.lit("ROUTED")).alias("route_status"),
        F.when(company.isNotNull(), paths.tenant_path(company, F.lower(kind), "file_name")).alias("target_path"),
    )
