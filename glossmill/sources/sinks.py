"""Writers: whole tables replaced as one, logs appended, small documents written by the driver.

A file of a name of its own is written by Spark as one part into a folder beside it, and then takes
the place of the old one in a single rename. With an expected hash, the old one must still be what
was read.
"""

from __future__ import annotations

import hashlib
import json
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossmill.operators import review
from glossmill.operators.quality import Violation
from glossmill.session import shared_folder
from glossmill.sources.readers import file_hash, file_hashes


def append_log(rows: DataFrame, path: str) -> None:
    """Rows to a JSONL log, nulls kept as they were given."""
    rows.write.mode("append").option("ignoreNullFields", False).json(path)


def _take_place(spark: SparkSession, staged: str, path: str, expected_sha256: str | None) -> str:
    """The one part of a staged folder becomes the file; returns its hash."""
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    folder, where = jvm.org.apache.hadoop.fs.Path(staged), jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(conf)
    try:
        parts = [s.getPath() for s in fs.listStatus(folder) if s.getPath().getName().startswith("part-")]
        if len(parts) != 1:
            raise Violation(f"{len(parts)} parts for {path}")
        if expected_sha256 is not None and (not fs.exists(where) or file_hash(spark, path) != expected_sha256):
            raise Violation(f"{path} changed since it was read")
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf)
        overwrite = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        fs.mkdirs(where.getParent())
        files.rename(fs.makeQualified(parts[0]), fs.makeQualified(where), overwrite)
    finally:
        fs.delete(folder, True)
    return file_hash(spark, path)


def _staging(path: str) -> str:
    return f"{path}.{uuid.uuid4().hex}.part"


def dialogue_file(rows: DataFrame, path: str, expected_sha256: str | None = None) -> str:
    """id, name, text, trans of one file in the order of ``at``, footer rows included; returns its hash."""
    staged = _staging(path)
    ordered = rows.select("at", "id", "name", "text", "trans").coalesce(1).sortWithinPartitions("at").drop("at")
    ordered.write.options(header=True, quote='"', escape='"', emptyValue="").csv(staged)
    return _take_place(rows.sparkSession, staged, path, expected_sha256)


def dialogue_progress(rows: DataFrame, batch: DataFrame, path: str, source_path: str, expected_sha256: str) -> str:
    """A batch's translations (id, trans) put into a file, whose source must be the one that its footer
    names and which must be as it was after the batch before. Returns its new hash."""
    spark = rows.sparkSession
    recorded = rows.where("id = 'info'").select("text").first()
    if recorded is None or recorded["text"] != file_hash(spark, source_path):
        raise Violation(f"{source_path} is not the source of {path}")
    new = batch.select("id", F.col("trans").alias("_new"))
    joined = rows.join(new, "id", "left").withColumn("trans", F.when((F.col("trans") == "") & F.col("_new").isNotNull(), F.col("_new")).otherwise(F.col("trans")))
    return dialogue_file(joined.drop("_new"), path, expected_sha256)


def dialogue_files(rows: DataFrame, held: dict[str, str]) -> dict[str, tuple[str, str | None]]:
    """Writes whole files, each in a task, and then puts one after the other in its place; what became of each
    path: ("written", its new hash) or ("changed", None) if it is no longer what ``held`` says was read.

    rows: path, at, id, name, text, trans, footers included. Parts are staged beside nothing that exists, so
    a file is the old one or the new one whatever happens to the others.
    """
    spark = rows.sparkSession
    if not held:
        return {}
    staged = f"{shared_folder(spark)}/glossmill-files-{uuid.uuid4().hex}"
    names = {path: f"f{i}" for i, path in enumerate(sorted(held))}
    told = spark.createDataFrame(list(names.items()), "path string, _file string")
    ordered = rows.join(told, "path").select("_file", "at", "id", "name", "text", "trans").repartition("_file").sortWithinPartitions("_file", "at").drop("at")
    ordered.write.options(header=True, quote='"', escape='"', emptyValue="").partitionBy("_file").csv(staged)
    folder = os.path.commonpath(list(held)) if len(held) > 1 else next(iter(held))
    now = {r["path"]: r["sha256"] for r in file_hashes(spark, folder, "adv_*.csv").where(F.col("path").isin(*held)).collect()}
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    out, at = {}, jvm.org.apache.hadoop.fs.Path
    fs = at(staged).getFileSystem(conf)
    for path, name in names.items():
        if now.get(path) != held[path]:
            out[path] = ("changed", None)
            continue
        out[path] = ("written", _take_place(spark, f"{staged}/_file={name}", path, None))
    fs.delete(at(staged), True)
    return out


def record_tables_json(rows: DataFrame, path: str) -> None:
    """Records as JSON lines (id, record) in a folder for each table, in their order."""
    pair = F.array_sort(F.collect_list(F.struct("seq", "field", "source")))
    records = rows.groupBy("tbl", "id").agg(F.min("seq").alias("seq"), F.map_from_entries(F.transform(pair, lambda x: F.struct(x["field"], x["source"]))).alias("record"))
    records.repartition("tbl").sortWithinPartitions("tbl", "seq").select("tbl", "id", "record").write.mode("overwrite").partitionBy("tbl").json(path)


def _quoted(c) -> F.Column:
    """A text as JSON."""
    return F.regexp_replace(F.to_json(F.array(c)), r"(?s)\A\[|\]\z", "")


def record_documents(rows: DataFrame, folder: str, expected: dict[str, str] | None = None) -> dict[str, str]:
    """Each table of (tbl, id, field, source, seq) as an indented JSON document ``tbl``.json in the folder, records
    and fields in the order of ``seq``; returns their hashes. ``expected``: what existing documents must
    hash to, by table.

    Records are put in order by ranges, so a table of any size is formatted in many tasks; its parts are
    then laid end to end and take the place of the document in one rename.
    """
    spark = rows.sparkSession
    pair = F.array_sort(F.collect_list(F.struct("seq", "field", _quoted("source").alias("text"))))
    fields = F.array_join(F.transform(pair, lambda x: F.concat(F.lit("    "), _quoted(x["field"]), F.lit(": "), x["text"])), ",\n")
    records = rows.groupBy("tbl", "id").agg(F.min("seq").alias("seq"), fields.alias("fields"))
    ends = rows.groupBy("tbl").agg(F.max("seq").alias("x")).join(records.groupBy("tbl").agg(F.max("seq").alias("last")), "tbl").select("tbl", "last")
    end = F.when(F.col("seq") == F.col("last"), "  }\n}").otherwise("  },")
    line = F.concat(F.lit("  "), _quoted("id"), F.lit(": {\n"), "fields", F.lit("\n"), end)
    body = records.join(F.broadcast(ends), "tbl").select("tbl", "seq", line.alias("value"))  # a row a document
    head = ends.select("tbl", F.lit(None).cast(dict(rows.dtypes)["seq"]).alias("seq"), F.lit("{").alias("value"))
    order = [F.col("tbl").asc(), F.col("seq").asc_nulls_first()]
    staged = f"{shared_folder(spark)}/glossmill-documents-{uuid.uuid4().hex}"
    head.unionByName(body).repartitionByRange(*order).sortWithinPartitions(*order).select("tbl", "value").write.partitionBy("tbl").text(staged)
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    at, out = jvm.org.apache.hadoop.fs.Path, {}
    fs = at(staged).getFileSystem(conf)
    try:
        for part in fs.listStatus(at(staged)):
            name = part.getPath().getName()
            if name.startswith("tbl="):
                table = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName(name.removeprefix("tbl="))
                _laid_end_to_end(spark, part.getPath())
                out[table] = _take_place(spark, part.getPath().toString(), f"{folder.rstrip('/')}/{table}.json", (expected or {}).get(table))
    finally:
        fs.delete(at(staged), True)
    return out


def _laid_end_to_end(spark: SparkSession, folder) -> None:
    """The parts of a folder, in their order, as its only one; their bytes are copied, not held."""
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    fs = folder.getFileSystem(conf)
    parts = sorted((s.getPath() for s in fs.listStatus(folder) if s.getPath().getName().startswith("part-")), key=lambda p: p.getName())
    if len(parts) < 2:
        return
    out = fs.create(jvm.org.apache.hadoop.fs.Path(folder, "whole"), False)
    try:
        for part in parts:
            stream = fs.open(part)
            try:
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, out, conf, False)
            finally:
                stream.close()
    finally:
        out.close()
    for part in parts:
        fs.delete(part, False)
    fs.rename(jvm.org.apache.hadoop.fs.Path(folder, "whole"), jvm.org.apache.hadoop.fs.Path(folder, "part-whole"))


def record_table_document(rows: DataFrame, path: str, expected_sha256: str | None = None) -> str:
    """One table (id, field, source, seq) as a document of that path; returns its hash."""
    folder, _, name = path.rpartition("/")
    table = name.removesuffix(".json")
    if f"{folder}/{table}.json" != path:
        raise Violation(f"{path} is no .json")
    return record_documents(rows.withColumn("tbl", F.lit(table)), folder, {table: expected_sha256} if expected_sha256 else None)[table]


def plan_jobs(jobs: DataFrame, path: str, header: dict) -> None:
    """A plan: its jobs as JSON lines, and a header beside them, which comes last so that it is whole."""
    jobs.write.mode("overwrite").option("ignoreNullFields", False).json(path)
    jobs.sparkSession.createDataFrame([(json.dumps(header, ensure_ascii=False, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}.header")


def pending_list(pages: DataFrame, path: str, source_sha256: str) -> None:
    """page and its sources as JSON lines, each with the hash of the document that they come from."""
    pages.withColumn("source_sha256", F.lit(source_sha256)).write.mode("overwrite").json(path)


def review_package(queued: DataFrame, path: str, previous: DataFrame | None = None, inputs: dict[str, str] | None = None) -> None:
    """A folder with the queue, the decisions, those that went stale, and a manifest of inputs and counts.

    Nothing of it is written over one of the inputs; decisions on unchanged items are kept.
    """
    spark = queued.sparkSession
    outside(path, list(inputs or {}))
    blank = spark.createDataFrame([], "review_id string, input_fingerprint string, decision string, selected_target string, notes string, reviewer string")
    items, stale = review.merged_decisions(queued, blank if previous is None else previous)
    queued.write.mode("overwrite").json(f"{path}/queue")
    items.write.mode("overwrite").option("ignoreNullFields", False).json(f"{path}/decisions.new")
    stale.write.mode("append").option("ignoreNullFields", False).json(f"{path}/stale_decisions")
    counts = {(r["counted"], r["name"]): r["n"] for r in review.queue_counts(queued).collect()}  # kinds and flags are few
    summary = {"inputs": inputs or {}, **{f"{counted}:{name}": n for (counted, name), n in counts.items()}}
    spark.createDataFrame([(json.dumps(summary, ensure_ascii=False, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/manifest")


def outside(path: str, inputs: list[str]) -> None:
    """Raise if an output lies within one of the inputs, or is one."""
    own = path.rstrip("/") + "/"
    for i in inputs:
        if own.startswith(i.rstrip("/") + "/"):
            raise Violation(f"{path} lies within the input {i}")


def document_json(document: dict, path: str, expected_sha256: str | None = None) -> None:
    """A small report by the driver, complete or not at all.

    With ``expected_sha256`` the file must still be as it was when read.
    """
    if expected_sha256 is not None:
        with open(path, "rb") as held:
            if hashlib.sha256(held.read()).hexdigest() != expected_sha256:
                raise Violation(f"{path} changed since it was read")
    part = f"{path}.part"
    with open(part, "w", encoding="utf-8") as out:
        json.dump(document, out, ensure_ascii=False, indent=2, sort_keys=True)
        out.write("\n")
    os.replace(part, path)
