"""TSV, JSON, CSV and Markdown files of the pipeline."""

from __future__ import annotations

import json
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinspan.schema import SOURCE_COLUMNS, TRUTH_COLUMNS


def _load(spark: SparkSession, path: str, columns: list[str], limit: int | None) -> DataFrame:
    """All columns as strings; an empty field is "" and NA stays NA; raises where a column is missing, leaves out others.

    Files are split among tasks unless a quoted field goes over a line's end, which a line with an odd number of quotes tells."""
    value = F.col("value")
    open_ = spark.read.text(str(path)).where((F.length(value) - F.length(F.replace(value, F.lit('"'), F.lit("")))) % 2 == 1).head(1)
    df = spark.read.options(sep="\t", header=True, escape='"', multiLine=bool(open_), encoding="UTF-8", inferSchema=False).csv(str(path))
    if missing := [c for c in columns if c not in df.columns]:
        raise ValueError(f"{path} is missing expected columns: {missing}")
    df = df.select(*columns).na.fill("")
    return df if limit is None else df.limit(limit)


def load_source(spark: SparkSession, path: str, nrows: int | None = None) -> DataFrame:
    return _load(spark, path, SOURCE_COLUMNS, nrows)


def load_truth(spark: SparkSession, path: str, nrows: int | None = None) -> DataFrame:
    return _load(spark, path, TRUTH_COLUMNS, nrows)


def write_tsv(df: DataFrame, path: str) -> None:
    """One TSV file at path: fields are quoted only where they must be, an empty string stays empty.

    The rows go through a single task, as one file needs; write_tsv_parts does without."""
    spark, tmp = df.sparkSession, f"{path}.parts"
    write_tsv_parts(df.coalesce(1), tmp)
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    top = jvm.org.apache.hadoop.fs.Path(tmp)
    fs = top.getFileSystem(conf)
    part = next(s.getPath() for s in fs.listStatus(top) if s.getPath().getName().startswith("part-"))
    target = jvm.org.apache.hadoop.fs.Path(str(path))
    fs.delete(target, False)
    fs.rename(part, target)
    fs.delete(top, True)
    crc = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}.crc")
    fs.delete(crc, False)


def write_tsv_parts(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(sep="\t", header=True, emptyValue="", escape='"').csv(str(path))


def write_csv(df: DataFrame, path: str) -> None:
    """A small table, such as a threshold grid, as one CSV file on the driver."""
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    df.toPandas().to_csv(path, index=False)


def write_json(value: dict | DataFrame, path: str) -> None:
    """A dict, or a table's only row, as JSON in UTF-8."""
    if isinstance(value, DataFrame):
        value = value.first().asDict(recursive=True)
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(json.dumps(value, indent=2, ensure_ascii=False), encoding="utf-8")


def read_json(path: str) -> dict:
    return json.loads(Path(path).read_text(encoding="utf-8"))


def write_profile_report(profiles: dict[str, dict], path: str, title: str = "Data profile") -> None:
    """A Markdown report: a section for each table, a line for each figure."""
    lines = [f"# {title}", ""]
    for name, figures in profiles.items():
        lines += [f"## {name}", *[f"- {k}: {v}" for k, v in figures.items()], ""]
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text("\n".join(lines), encoding="utf-8")


def package(files: dict[str, str], path: str) -> None:
    """A zip archive of files, by their names within it; folders are taken whole. Raises where one is missing."""
    if lost := [f for f in files.values() if not Path(f).exists()]:
        raise FileNotFoundError(", ".join(lost))
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for name, f in files.items():
            for one in sorted(Path(f).rglob("*")) if Path(f).is_dir() else [Path(f)]:
                if one.is_file():
                    out.write(one, f"{name}/{one.relative_to(f)}" if Path(f).is_dir() else name)
