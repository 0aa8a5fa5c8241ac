"""Sinks: documents as files or tables, and a batch's exit status."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_table(df: DataFrame, path: str, by: str | None = None) -> None:
    """K2 as a table, partitioned by a column of few values."""
    w = df.write.mode("overwrite")
    (w.partitionBy(by) if by else w).parquet(path)


def write_documents(docs: DataFrame, path: str) -> DataFrame:
    """K2: each document (doc_id, xml) as a file below path (a shared folder's URI); gives the names.

    A file is written under a temporary name and moved, so a task that runs twice leaves whole files.
    """

    def run(batches):
        import uuid

        import pyarrow as pa
        from pyarrow.fs import FileSystem

        fs, root = FileSystem.from_uri(path)
        fs.create_dir(root, recursive=True)
        for batch in batches:
            names = []
            for name, xml in zip(batch.column("doc_id").to_pylist(), batch.column("xml").to_pylist(), strict=True):
                safe = "".join(c if c.isalnum() or c in "-_." else "_" for c in name)
                part = f"{root}/.{safe}-{uuid.uuid4().hex}"
                with fs.open_output_stream(part) as f:
                    f.write((xml or "").encode())
                fs.move(part, f"{root}/{safe}.xml")
                names.append(f"{safe}.xml")
            yield pa.RecordBatch.from_pydict({"file": names}, schema=pa.schema([("file", pa.string())]))

    return docs.select("doc_id", "xml").mapInArrow(run, "file string")


def exit_status(reports: DataFrame, rejects: DataFrame | None = None, strict: bool = False) -> int:
    """K5: 1 for failures under strict, else 0."""
    failed = not reports.where("NOT ok").isEmpty() or (rejects is not None and not rejects.isEmpty())
    return int(strict and failed)
