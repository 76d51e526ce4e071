"""Arrow batch builders used inside scan tasks (bounded batches, columnar construction)."""

from __future__ import annotations

import pyarrow as pa

CELL_TYPE = pa.struct([("k", pa.string()), ("n", pa.float64()), ("s", pa.string())])
CELLS_TYPE = pa.map_(pa.int32(), CELL_TYPE)

ROWS_SCHEMA = pa.schema(
    [
        ("path", pa.string()),
        ("sheet", pa.string()),
        ("row_idx", pa.int32()),
        ("seq", pa.int64()),
        ("hidden", pa.bool_()),
        ("date1904", pa.bool_()),
        ("rowid", CELL_TYPE),
        ("cells", CELLS_TYPE),
    ]
)
ROWS_DDL = (
    "path string, sheet string, row_idx int, seq long, hidden boolean, date1904 boolean, "
    "rowid struct<k:string,n:double,s:string>, cells map<int,struct<k:string,n:double,s:string>>"
)

SAMPLE_SCHEMA = pa.schema(
    [
        ("path", pa.string()),
        ("col", pa.int32()),
        ("name", pa.string()),
        ("date1904", pa.bool_()),
        ("cells", pa.list_(CELL_TYPE)),
    ]
)
SAMPLE_DDL = (
    "path string, col int, name string, date1904 boolean, "
    "cells array<struct<k:string,n:double,s:string>>"
)


class RowsBuilder:
    """Accumulates sheet rows and flushes them as Arrow record batches."""

    def __init__(self, max_rows: int = 8192, max_cells: int = 262144):
        self.max_rows = max_rows
        self.max_cells = max_cells
        self._reset()

    def _reset(self):
        self.path, self.sheet, self.row_idx, self.seq = [], [], [], []
        self.hidden, self.d1904, self.rowid = [], [], []
        self.offsets = [0]
        self.keys, self.kinds, self.nums, self.txts = [], [], [], []

    def add(self, path, sheet, row_idx, seq, hidden, date1904, rowid, cells):
        self.path.append(path)
        self.sheet.append(sheet)
        self.row_idx.append(row_idx)
        self.seq.append(seq)
        self.hidden.append(hidden)
        self.d1904.append(date1904)
        self.rowid.append(None if rowid is None else {"k": rowid[1], "n": rowid[2], "s": rowid[3]})
        for key, k, n, s in cells:
            self.keys.append(key)
            self.kinds.append(k)
            self.nums.append(n)
            self.txts.append(s)
        self.offsets.append(len(self.keys))

    def full(self) -> bool:
        return len(self.path) >= self.max_rows or len(self.keys) >= self.max_cells

    def __len__(self):
        return len(self.path)

    def flush(self) -> pa.RecordBatch:
        items = pa.StructArray.from_arrays(
            [pa.array(self.kinds, pa.string()), pa.array(self.nums, pa.float64()),
             pa.array(self.txts, pa.string())],
            fields=list(CELL_TYPE),
        )
        cells = pa.MapArray.from_arrays(pa.array(self.offsets, pa.int32()), pa.array(self.keys, pa.int32()),
                                        items)
        batch = pa.RecordBatch.from_arrays(
            [
                pa.array(self.path, pa.string()),
                pa.array(self.sheet, pa.string()),
                pa.array(self.row_idx, pa.int32()),
                pa.array(self.seq, pa.int64()),
                pa.array(self.hidden, pa.bool_()),
                pa.array(self.d1904, pa.bool_()),
                pa.array(self.rowid, CELL_TYPE),
                cells,
            ],
            schema=ROWS_SCHEMA,
        )
        self._reset()
        return batch


def sample_batch(records: list) -> pa.RecordBatch:
    """records: (path, col, name, date1904, [(k, n, s), ...])."""
    paths, cols, names, d1904, offsets = [], [], [], [], [0]
    kinds, nums, txts = [], [], []
    for path, col, name, d, cells in records:
        paths.append(path)
        cols.append(col)
        names.append(name)
        d1904.append(d)
        for k, n, s in cells:
            kinds.append(k)
            nums.append(n)
            txts.append(s)
        offsets.append(len(kinds))
    items = pa.StructArray.from_arrays(
        [pa.array(kinds, pa.string()), pa.array(nums, pa.float64()), pa.array(txts, pa.string())],
        fields=list(CELL_TYPE),
    )
    lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), items)
    return pa.RecordBatch.from_arrays(
        [pa.array(paths, pa.string()), pa.array(cols, pa.int32()), pa.array(names, pa.string()),
         pa.array(d1904, pa.bool_()), lists],
        schema=SAMPLE_SCHEMA,
    )
