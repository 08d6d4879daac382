"""ZIP archives of CSV, one for each Arrow batch of rows."""

from __future__ import annotations

import csv
import io
import zipfile

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from briefloom.sinks.files import file_writer


def write_zip_csv(df: DataFrame, folder: str, name_by: str, notes: dict[str, str] | None = None, member: str = "rows.csv") -> DataFrame:
    """Writes the rows (as text) and returns the archives' (name, rows); the result is lazy.

    An archive is named by the ``name_by`` value of its first row, which must differ between rows. ``notes`` are further
    members, put first. A repeated attempt replaces the same archive; for ``folder`` see ``file_writer``.
    """
    columns = df.columns
    place = columns.index(name_by)

    def run(batches):
        put = file_writer(folder)
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = list(zip(*(c.to_pylist() for c in batch.columns)))
            text = io.StringIO(newline="")
            csv.writer(text, lineterminator="\n").writerows([columns, *rows])
            held = io.BytesIO()
            with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as archive:
                for name, content in (notes or {}).items():
                    archive.writestr(name, content)
                archive.writestr(member, text.getvalue())
            name = f"part-{rows[0][place]}.zip"
            put(name, held.getvalue())
            yield pa.RecordBatch.from_pydict({"name": [name], "rows": [len(rows)]}, pa.schema([("name", pa.string()), ("rows", pa.int64())]))

    return df.select(*[F.col(c).cast("string") for c in columns]).mapInArrow(run, "name string, rows long")
