"""Checks of result files: what is wrong with their form, as a table of findings."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kinspan.schema import CANDIDATE_COLUMNS, TRUTH_COLUMNS

SHOWN = 5
SCHEMA = "severity string, file string, rule string, n long, examples string"


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """The first column of a TSV file, without its header and blank lines."""
    lines = _lines(spark, path).where((F.col("no") > 1) & (F.trim("line") != ""))
    return lines.select(F.trim(F.split("line", "\t")[0]).alias("entity_id")).distinct()


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(no, at, line) of a text file or of each of a folder's parts: no is the line's number within its file, from 1.

    Lines are counted split by split; a line's number is its place within the split and the lines of the splits before."""
    text = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    sizes = text.groupBy("file", "block").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    sizes = sizes.withColumn("before", F.sum("n").over(Window.partitionBy("file").orderBy("block")) - F.col("n"))  # a row for each split
    text = text.join(F.broadcast(sizes), ["file", "block"])
    return text.select((F.col("at") - F.col("first") + F.col("before") + 1).alias("no"), "at", F.col("value").alias("line"))


def header_problem(header: str | None, expected: list[str], name: str) -> tuple[str, str] | None:
    """(rule, message) of a header that stops the check: none, commas for tabs, other columns."""
    if not header:
        return "empty_file", f"{name} is empty"
    if "\t" not in header and "," in header:
        return "comma_separated", f"{name}: the header has commas and no tab"
    found = [c.strip().lower() for c in header.split("\t")]
    return None if found == expected else ("unexpected_header", f"{name}: {found} where {expected} belongs")


def parse_rows(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows (at, s1, ids), malformed (no, line)) of the lines after the header; blank lines are neither."""
    has_tab = F.instr("line", "\t") > 0
    rest = F.substr(F.col("line"), F.instr("line", "\t") + 1)
    ids = F.when(F.trim(rest) == "", F.array().cast("array<string>")).otherwise(F.split(rest, ",", -1))
    rows = lines.where(has_tab).select("at", F.substring_index("line", "\t", 1).alias("s1"), ids.alias("ids"))
    return rows, lines.where(~has_tab & (F.trim("line") != "")).select("no", "line")


def _finding(items: DataFrame, rule: str, file: str, severity: str = "error") -> DataFrame:
    """One row of findings from a column `item`, none where there is no item. Only a rule's first few items are kept anywhere."""
    items = items.select(F.col("item").cast("string").alias("item")).distinct()
    few = items.orderBy("item").limit(SHOWN).agg(F.array_join(F.array_sort(F.collect_list("item")), ", ").alias("examples"))
    return items.agg(F.count("*").alias("n")).crossJoin(F.broadcast(few)).where("n > 0").select(F.lit(severity).alias("severity"), F.lit(file).alias("file"), F.lit(rule).alias("rule"), "n", "examples")


def check_rows(rows: DataFrame, required: DataFrame, valid_ids: DataFrame | None, file: str) -> DataFrame:
    """Findings over rows (s1, ids): repeated rows and ids, ids of a wrong kind or unknown, required rows that are missing and others."""
    each = rows.select("s1", F.explode(F.array_distinct("ids")).alias("id"))
    kind = F.when(F.col("id").startswith("S1-"), "self_match").when(~F.col("id").rlike("^S[23]-"), "wrong_prefix").otherwise("ok")
    each = each.withColumn("kind", kind)
    need = required.select(F.col("entity_id").alias("item")).distinct()
    seen = rows.select(F.col("s1").alias("item")).distinct()
    found = [
        _finding(rows.groupBy("s1").count().where("count > 1").select(F.col("s1").alias("item")), "duplicate_row", file),
        _finding(rows.where(F.size("ids") != F.size(F.array_distinct("ids"))).select(F.col("s1").alias("item")), "duplicate_id_in_list", file),
        _finding(each.where("kind = 'self_match'").select(F.col("id").alias("item")), "self_match", file),
        _finding(each.where("kind = 'wrong_prefix'").select(F.col("id").alias("item")), "wrong_prefix", file),
        _finding(need.join(seen, "item", "left_anti"), "missing_required", file),
        _finding(seen.join(need, "item", "left_anti"), "extra_row", file),
    ]
    if valid_ids is not None:
        known = valid_ids.select(F.col("entity_id").alias("item")).distinct()
        found.append(_finding(each.where("kind = 'ok'").select(F.col("id").alias("item")).join(known, "item", "left_anti"), "unknown_id", file))
    out = found[0]
    for x in found[1:]:
        out = out.unionByName(x)
    return out


def row_counts(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count("*").alias("n_rows"), F.count_if(F.size("ids") == 0).alias("n_empty"), F.count_if(F.size("ids") > 0).alias("n_non_empty"))


def not_candidates(matched: DataFrame, candidates: DataFrame, file: str) -> DataFrame:
    """A warning that names records with matched ids that were no candidates of theirs."""
    pairs = lambda rows: rows.select("s1", F.explode("ids").alias("id")).distinct()
    return _finding(pairs(matched).join(pairs(candidates), ["s1", "id"], "left_anti").select(F.col("s1").alias("item")), "not_a_candidate", file, "warning")


def validate_files(spark: SparkSession, matching: str, candidate: str | None, source1: str, targets: list[str] | None = None) -> DataFrame:
    """Findings (severity, file, rule, n, examples) over the result files: the matches, and the candidates if there are any.

    targets: the S2 and S3 files; with them every id must exist there. Files that are missing or not UTF-8 are findings, too."""
    notes: list[tuple] = []

    def exists(path: str) -> bool:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)

    def table() -> DataFrame:
        return spark.createDataFrame(notes, SCHEMA)

    if not exists(source1):
        notes.append(("error", source1, "missing_file", 1, source1))
        return table()
    required, valid = read_ids(spark, source1), None
    if targets is None:
        notes.append(("warning", matching, "ids_not_checked", 1, ""))
    elif lost := [t for t in targets if not exists(t)]:
        notes.append(("warning", lost[0], "missing_targets", len(lost), ", ".join(lost[:SHOWN])))
    else:
        for t in targets:
            valid = read_ids(spark, t) if valid is None else valid.union(read_ids(spark, t))
    out, parsed = None, {}
    for path, columns in ((matching, TRUTH_COLUMNS), (candidate, CANDIDATE_COLUMNS)):
        if path is None:
            continue
        if not exists(path):
            notes.append(("error" if path == matching else "warning", path, "missing_file", 1, path))
            continue
        head = spark.read.text(path).head(1)
        if any("�" in r.value for r in head) or spark.read.text(path).where(F.contains("value", F.lit("�"))).head(1):
            notes.append(("error", path, "not_utf8", 1, path))
            continue
        if problem := header_problem(head[0].value if head else None, columns, path):
            notes.append(("error", path, problem[0], 1, problem[1]))
            continue
        rows, bad = parse_rows(_lines(spark, path).where("no > 1"))
        parsed[path] = rows
        for found in (_finding(bad.select(F.format_string("line %06d: %s", "no", "line").alias("item")), "malformed_row", path), check_rows(rows, required, valid, path)):
            out = found if out is None else out.unionByName(found)
    if matching in parsed and candidate in parsed:
        out = out.unionByName(not_candidates(parsed[matching], parsed[candidate], matching))
    return table() if out is None else out.unionByName(table())


def passed(findings: DataFrame) -> bool:
    return not findings.where("severity = 'error'").head(1)


def main(arguments: list[str] | None = None) -> int:
    """Command line: prints every finding and PASS or FAIL; the exit code is 0 or 1."""
    parser = argparse.ArgumentParser(prog="python -m kinspan.operators.validate", description="Checks result files.")
    parser.add_argument("--matching", required=True, help="TSV of the matches")
    parser.add_argument("--candidates", help="TSV of the candidates")
    parser.add_argument("--source1", required=True, help="TSV of the records that need a row each")
    parser.add_argument("--check-ids", nargs="*", metavar="TSV", help="TSV files of the records that ids must be of")
    given = parser.parse_args(arguments)
    spark = SparkSession.builder.getOrCreate()
    findings = validate_files(spark, given.matching, given.candidates, given.source1, given.check_ids)
    rows = findings.orderBy("severity", "file", "rule").collect()  # a row for each rule at most
    for r in rows:
        print(f"{r.severity.upper()} {r.file}: {r.rule} ({r.n}): {r.examples}")
    good = not any(r.severity == "error" for r in rows)
    print("PASS" if good else "FAIL")
    return 0 if good else 1


if __name__ == "__main__":
    sys.exit(main())
