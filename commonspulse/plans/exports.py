"""Sinks: document files, CSV and manifests.

Document files are written by the tasks that hold the rows, on a path that all
executors and the driver share.  Each file is written beside its target and
renamed, so a repeated or lost task leaves whole files only.
"""

from __future__ import annotations

import json
import os
import sys
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from datetime import date

from pyarrow.fs import FileSystem, LocalFileSystem
from pyspark import StorageLevel, cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from commonspulse import constants as C
from commonspulse.plans import documents as D

# Executors get the file writer with the task and need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def write_file(path: str, text: str) -> None:
    store, place = FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (LocalFileSystem(), path)
    store.create_dir(os.path.dirname(place), recursive=True)
    beside = f"{place}.{uuid.uuid4().hex}.tmp"
    with store.open_output_stream(beside) as out:
        out.write(f"{text}\n".encode())
    store.move(beside, place)


def write_named_files(rows: DataFrame, root: str) -> None:
    """Write ``body`` of each row to the relative path in ``file``."""
    def write_all(part: Iterable[Row]) -> None:
        for row in part:
            write_file(os.path.join(root, row["file"]), row["body"])

    rows.select("file", "body").foreachPartition(write_all)


def write_document_lines(documents: DataFrame, path: str) -> None:
    """The same documents as JSON lines in one folder per shard, for very many organizations."""
    D.document_text(documents).select("shard", "body").write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("shard").text(path)


def _manifest_file(manifest: DataFrame, path: str, **more: object) -> dict:
    row = manifest.collect()[0].asDict(recursive=True)
    row.update(more)
    write_file(path, json.dumps(row, ensure_ascii=False, indent=2))
    return row


@contextmanager
def _kept(panel: DataFrame, key: str) -> Iterator[DataFrame]:
    """The panel, kept on the executors while its several outputs are written; the months of a ``key`` lie together."""
    together = panel.repartition(key).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield together
    finally:
        together.unpersist()


def export_login_json(panel: DataFrame, root: str, start: str | date, end: str | date) -> dict:
    """One compact document per organization below its shard, and the manifest last."""
    with _kept(panel, "org_login") as panel:
        rows = D.document_text(D.named_apart(D.login_documents(panel, start, end)))
        name = F.concat_ws("/", "shard", F.concat("safe_login", F.lit(".json")))
        write_named_files(rows.select(name.alias("file"), "body"), root)
        return _manifest_file(D.login_manifest(panel, start, end), os.path.join(root, "manifest.json"))


def export_targets(targets: DataFrame, panel: DataFrame, root: str, start: str | date, end: str | date) -> dict:
    """A document per target, the combined CSV and the manifest."""
    with _kept(panel, "organization_id") as panel:
        unknown = D.unknown_ids(panel, targets).limit(5).collect()
        if unknown:
            raise ValueError(f"Panel rows for ids that are no target: {[r[0] for r in unknown]}")
        rows = D.document_text(D.target_documents(targets, panel, start, end), pretty=True)
        name = F.concat(F.col("organization_id").cast("string"), F.lit(".json"))
        write_named_files(rows.select(name.alias("file"), "body"), root)
        write_csv(D.target_csv_rows(targets, panel, start, end), os.path.join(root, C.TARGET_CSV_NAME))

        D.target_file_names(targets).write.mode("overwrite").text(os.path.join(root, "manifest_files"))
        return _manifest_file(D.target_manifest(targets, start, end), os.path.join(root, "manifest.json"),
                              json_files_table="manifest_files")


def write_csv(rows: DataFrame, path: str) -> None:
    """CSV folder with a header in every part; null is written as nothing."""
    rows.write.mode("overwrite").options(
        header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, emptyValue="").csv(path)
