"""Workbooks made from tables by Spark, as a frame of files. For queries and tests only."""

from __future__ import annotations

from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from fixtures.make_workbooks import BLANK, Date, Sheet, build_workbook, column_name

ROWS_PER_WORKBOOK = 1000
FILES = "path string, modificationTime timestamp, length bigint, content binary"


def workbook_frame(df: DataFrame, number: str, columns: list[str], *, sheet: str | None = None,
                   carry: str | None = None, merge: str | None = None) -> DataFrame:
    """``files(path, modificationTime, length, content)``: one workbook per value of ``number`` (an expression).

    ``sheet`` names a column that picks the sheet of a row; ``carry`` one that is kept beside the file like a
    partition column; ``merge`` one whose repeats are merged down the sheet. Each group is one workbook's rows.
    """
    extra = [c for c in (sheet, carry) if c and c not in columns]
    keyed = df.selectExpr(f"{number} AS _no", *[f"`{c}`" for c in columns + extra])
    times = [f.name for f in df.schema if f.dataType.simpleString().startswith("timestamp")]

    def build(pdf):
        no = int(pdf["_no"].iloc[0])
        pdf = pdf.sort_values([merge, *columns] if merge else columns)
        sheets = []
        for name, part in sorted(pdf.groupby(sheet)) if sheet else [("Sheet1", pdf)]:
            values = []
            for c in columns:
                series = part[c]
                if c in times:
                    micros = series.to_numpy().astype("datetime64[us]").astype(np.int64)
                    values.append([Date(m / 86400e6 + 25569) for m in micros])
                else:
                    values.append([x.item() if hasattr(x, "item") else x for x in series])
            rows = [list(r) for r in zip(*values)]
            merges = []
            if merge:
                at, start = columns.index(merge), 0
                letter = column_name(at)
                for i in range(1, len(rows) + 1):
                    if i == len(rows) or rows[i][at] != rows[start][at]:
                        if i - start > 1:
                            merges.append(f"{letter}{start + 2}:{letter}{i + 1}")
                        start = i
                previous = None
                for r in rows:
                    r[at], previous = (BLANK if r[at] == previous else r[at]), r[at]
            sheets.append(Sheet(str(name), [columns, *rows], merges))
        content = build_workbook(sheets, level=1)
        out = {"path": [f"book-{no:08d}.xlsx"], "modificationTime": [pd.Timestamp(2024, 1, 1)],
               "length": [len(content)], "content": [content]}
        if carry:
            out[carry] = [pdf[carry].iloc[0]]
        return pd.DataFrame(out)

    schema = FILES + (f", {carry} {df.schema[carry].dataType.simpleString()}" if carry else "")
    keys = ["_no"] + ([carry] if carry else [])
    return keyed.groupBy(*keys).applyInPandas(build, schema)


def save_books(books: DataFrame, folder: str, under: str = "''") -> str:
    """Writes the workbooks of a frame as files, by the tasks that make them; ``under`` (SQL) names a sub-folder of each.

    Needs a folder that tasks can write to as a path. Gives the folder back.
    """
    root = folder.removeprefix("file://").removeprefix("file:")

    def save(batches):
        for pdf in batches:
            for path, content, sub in zip(pdf["path"], pdf["content"], pdf["sub"]):
                place = Path(root, sub)
                place.mkdir(parents=True, exist_ok=True)
                (place / path).write_bytes(content)
            yield pd.DataFrame({"n": [len(pdf)]})

    books.selectExpr("path", "content", f"{under} AS sub").mapInPandas(save, "n long").agg({"n": "sum"}).collect()
    return folder
