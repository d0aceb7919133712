"""SRC14 over files: the folders ``night=N`` of alerts that STR5 writes, read as a
stream by a Spark data source with offsets of its own.

The messages of a stream are the rows of the Parquet files in order of night,
file name and row. An offset is (file, rows of it that are read), so a
micro-batch ends at any message, and a checkpoint goes on with the next one.
Files are immutable once visible, and a new one comes after all earlier ones in
that order (nights are released in time order); files whose names begin with
``_`` or ``.`` are not seen.
"""

from __future__ import annotations

import posixpath
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

FORMAT = "alert_nights"
#: Columns that the reader fills when the schema asks for them and the files lack them.
TRANSPORT = ("night", "file", "offset")


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path and the path in it (a URI of any scheme, or a plain path)."""
    if "://" not in path and not path.startswith("file:"):
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri(path if "://" in path else "file://" + path[5:])


class RowRange(InputPartition):
    """Rows [first, last) of one file; ``last`` None is its end."""

    def __init__(self, path: str, name: str, first: int, last: int | None):
        self.path, self.name, self.first, self.last = path, name, first, last


class NightReader(DataSourceStreamReader):
    def __init__(self, options: dict, schema: T.StructType):
        self.schema, self.path = schema, options["path"].rstrip("/")
        self.latest_first = options.get("startingoffsets", "earliest") == "latest"
        limit = options.get("maxmessagespertrigger")
        self.limit = int(limit) if limit else None
        self.task_bytes = int(options.get("taskbytes", 128 << 20))
        nights = options.get("nights")
        self.nights = {int(n) for n in nights.split(",")} if nights else None
        self.at: dict | None = None                     # end of the last planned micro-batch
        self.began: dict | None = None                  # where a stream without a checkpoint begins
        self.rows: dict[str, int] = {}

    def _files(self, after: str = "") -> list[tuple[tuple[int, str], str, int]]:
        """(order, name, bytes) of the files from ``after`` on, that one included."""
        fs, root = _open(self.path)
        since, found = _order(after) if after else (-1, ""), []
        for night in fs.get_file_info(pafs.FileSelector(root, allow_not_found=True)):
            n = _night(night.base_name)
            if night.type != pafs.FileType.Directory or n is None or n < since[0] or (self.nights is not None and n not in self.nights):
                continue
            for f in fs.get_file_info(pafs.FileSelector(night.path)):
                name = f"{night.base_name}/{f.base_name}"
                if f.type == pafs.FileType.File and f.base_name[0] not in "_." and _order(name) >= since:
                    found.append((_order(name), name, f.size))
        return sorted(found)

    def _count(self, name: str) -> int:
        if name not in self.rows:
            fs, root = _open(self.path)
            with fs.open_input_file(posixpath.join(root, name)) as f:
                self.rows[name] = pq.read_metadata(f).num_rows
        return self.rows[name]

    def _end(self) -> dict:
        files = self._files(self.at["file"] if self.at else "")
        return _offset(files[-1][1], self._count(files[-1][1])) if files else _offset("", 0)

    def initialOffset(self) -> dict:
        if self.began is None:
            self.began = self._end() if self.latest_first else _offset("", 0)
        return self.began

    def latestOffset(self) -> dict:
        """The end of the next micro-batch: ``maxMessagesPerTrigger`` messages on
        from the last one, or all there are. Only footers on the way are read."""
        self.at = self.at or self.initialOffset()
        if self.limit is None:
            return self._end()
        name, row, left = self.at["file"], self.at["row"], self.limit
        self.rows = {name: self.rows[name]} if name in self.rows else {}
        for _, f, _ in self._files(name):
            if left == 0:
                break
            row = row if f == name else 0
            step = min(left, self._count(f) - row)
            name, row, left = f, row + step, left - step
        return _offset(name, row)

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        """Whole files, larger ones in ranges of rows. After a restart Spark asks
        for the empty range at the last offset, which sets the place to go on from."""
        self.at = end
        if start == end:
            return []
        out = []
        for order, name, size in self._files(start["file"]):
            if order > _order(end["file"]):
                break
            first = start["row"] if name == start["file"] else 0
            last = end["row"] if name == end["file"] else None
            if size > self.task_bytes:
                stop = self._count(name) if last is None else last
                step = max(1, -(-self._count(name) * self.task_bytes // size))
                out += [RowRange(self.path, name, a, min(a + step, stop)) for a in range(first, stop, step)]
            elif last is None or last > first:
                out.append(RowRange(self.path, name, first, last))
        return out

    def read(self, partition: RowRange) -> Iterator[pa.RecordBatch]:
        want = to_arrow_schema(self.schema)
        fs, root = _open(partition.path)
        with fs.open_input_file(posixpath.join(root, partition.name)) as f:
            file = pq.ParquetFile(f)
            have = [c for c in want.names if c in file.schema_arrow.names]
            groups, begin, at = [], None, 0
            for g in range(file.num_row_groups):
                n = file.metadata.row_group(g).num_rows
                if at + n > partition.first and (partition.last is None or at < partition.last):
                    groups.append(g)
                    begin = at if begin is None else begin
                at += n
            row, stop = begin or 0, at if partition.last is None else partition.last
            for batch in file.iter_batches(batch_size=10_000, row_groups=groups, columns=have) if groups else ():
                a, z = max(partition.first - row, 0), min(stop - row, batch.num_rows)
                if z > a:
                    yield self._as_asked(batch.slice(a, z - a), partition.name, row + a, want)
                row += batch.num_rows

    @staticmethod
    def _as_asked(batch: pa.RecordBatch, name: str, row: int, want: pa.Schema) -> pa.RecordBatch:
        n = batch.num_rows
        made = {"night": lambda: pa.repeat(_night(name.split("/")[0]), n), "file": lambda: pa.repeat(name, n),
                "offset": lambda: pa.array(range(row, row + n), pa.int64())}
        cols = []
        for field in want:
            if field.name in batch.schema.names:
                cols.append(pc.cast(batch.column(field.name), field.type))
            elif field.name in made:
                cols.append(pc.cast(made[field.name](), field.type))
            else:
                cols.append(pa.nulls(n, field.type))
        return pa.RecordBatch.from_arrays(cols, schema=want)


class AlertNights(DataSource):
    """Options: ``path``; ``nights`` (a list to subscribe to, else all);
    ``startingOffsets`` earliest or latest; ``maxMessagesPerTrigger``; ``taskBytes``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> T.StructType:
        raise ValueError(f"give the schema of the alerts: readStream.format('{FORMAT}').schema(...)")

    def streamReader(self, schema: T.StructType) -> NightReader:
        return NightReader({k.lower(): v for k, v in self.options.items()}, schema)


def _offset(name: str, row: int) -> dict:
    return {"file": name, "row": row}


def _night(folder: str) -> int | None:
    key, _, value = folder.partition("=")
    return int(value) if key == "night" and value.lstrip("-").isdigit() else None


def _order(name: str) -> tuple[int, str]:
    night = _night(name.split("/")[0])
    return (-1 if night is None else night, name)
