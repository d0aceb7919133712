"""Bulk FITS binary-table ingestion (SRC3 HEAD, SRC4 PHOT).

The survey files are listed with the binary-file source (contents are not
read for the listing), the plain-vs-gzip twin is chosen per file number, and
each file is decoded by one task (``mapInPandas``) with a thin numpy decode
of the BINTABLE extension. Everything after that is ordinary DataFrame work.
"""

from __future__ import annotations

import gzip
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyflux.schemas import HEAD_DROP_COLUMNS, PHOT_COLUMNS

BLOCK = 2880
# FITS binary-table column codes -> (numpy big-endian code, Spark type)
TFORM = {"L": ("S1", T.BooleanType()), "B": ("u1", T.ShortType()), "I": (">i2", T.ShortType()),
         "J": (">i4", T.IntegerType()), "K": (">i8", T.LongType()), "E": (">f4", T.FloatType()),
         "D": (">f8", T.DoubleType()), "A": ("S", T.StringType())}
FILE_NUM = r"-(\d+)_(HEAD|PHOT)\.FITS(\.gz)?$"


def _cards(buf: bytes, start: int) -> tuple[dict, int]:
    """Header cards from ``start`` up to END; returns (cards, data offset)."""
    cards, pos = {}, start
    while True:
        block = buf[pos:pos + BLOCK]
        if len(block) < BLOCK:
            raise ValueError("truncated FITS header")
        pos += BLOCK
        for i in range(0, BLOCK, 80):
            card = block[i:i + 80].decode("ascii", "replace")
            key = card[:8].strip()
            if key == "END":
                return cards, pos
            if card[8:10] == "= ":
                val = card[10:].split("/")[0].strip() if not card[10:].strip().startswith("'") else \
                    card[10:].strip()[1:].split("'")[0].rstrip()
                cards[key] = val


def _columns(cards: dict) -> list[tuple[str, str, int]]:
    cols = []
    for i in range(1, int(cards["TFIELDS"]) + 1):
        m = re.match(r"(\d*)([LBIJKEDA])", cards[f"TFORM{i}"].strip())
        rep = int(m.group(1) or 1)
        cols.append((cards[f"TTYPE{i}"].strip(), m.group(2), rep))
    return cols


def table_header(buf: bytes) -> tuple[dict, int]:
    """Cards of the first BINTABLE extension and where its data starts."""
    prim, pos = _cards(buf, 0)
    naxis = int(prim.get("NAXIS", 0))
    size = 0
    if naxis:
        size = abs(int(prim["BITPIX"])) // 8
        for i in range(1, naxis + 1):
            size *= int(prim[f"NAXIS{i}"])
    pos += -(-size // BLOCK) * BLOCK
    return _cards(buf, pos)


def bintable_records(buf: bytes) -> tuple[np.ndarray, list[tuple[str, str, int]]]:
    """Zero-copy structured view of the first BINTABLE extension's rows."""
    if buf[:2] == b"\x1f\x8b":
        buf = gzip.decompress(buf)
    cards, pos = table_header(buf)
    cols = _columns(cards)
    dt = np.dtype([(n, (f"S{r}" if c == "A" else TFORM[c][0])) if c == "A" or r == 1
                   else (n, TFORM[c][0], (r,)) for n, c, r in cols])
    return np.frombuffer(buf, dtype=dt, count=int(cards["NAXIS2"]), offset=pos), cols


def records_to_pandas(arr: np.ndarray, cols: list[tuple[str, str, int]],
                      names: list[str] | None = None) -> pd.DataFrame:
    """Native-endian pandas frame of (a slice of) the records; strings trimmed."""
    out = {}
    for n, c, r in cols:
        if names is not None and n not in names:
            continue
        v = arr[n]
        if c == "A":
            out[n] = pd.Series(np.char.strip(np.char.decode(v, "ascii", "replace")), dtype=object)
        elif c == "L":
            out[n] = v == b"T"
        else:
            out[n] = v.astype(v.dtype.newbyteorder("="))
    return pd.DataFrame(out)


def decode_bintable(buf: bytes) -> pd.DataFrame:
    """Rows of the first BINTABLE extension as a pandas frame (strings trimmed)."""
    arr, cols = bintable_records(buf)
    return records_to_pandas(arr, cols)


def spark_schema(buf: bytes) -> T.StructType:
    """Spark schema of a table from its header bytes (no data needed)."""
    if buf[:2] == b"\x1f\x8b":
        buf = gzip.GzipFile(fileobj=__import__("io").BytesIO(buf)).read(BLOCK * 40)
    cards, _ = table_header(buf)
    return T.StructType([T.StructField(n, TFORM[c][1] if (c == "A" or r == 1) else T.ArrayType(TFORM[c][1]))
                         for n, c, r in _columns(cards)])


def encode_bintable(pdf: pd.DataFrame, strings: dict[str, int] | None = None) -> bytes:
    """A FITS file (empty primary HDU + one BINTABLE) from a pandas frame.
    Used to build fixtures; numeric columns keep their dtypes (int16/32/64,
    float32/64, bool), object columns become fixed-width strings."""
    strings = strings or {}
    codes = {np.dtype("int16"): "I", np.dtype("int32"): "J", np.dtype("int64"): "K",
             np.dtype("float32"): "E", np.dtype("float64"): "D", np.dtype("bool"): "L"}
    fields, forms, arrays = [], [], []
    for n in pdf.columns:
        s = pdf[n]
        if s.dtype == object:
            w = strings.get(n) or max(1, int(s.fillna("").astype(str).str.len().max() or 1))
            fields.append((n, f"S{w}"))
            forms.append(f"{w}A")
            arrays.append(s.fillna("").astype(str).str.encode("ascii").to_numpy())
        else:
            c = codes[s.dtype]
            fields.append((n, TFORM[c][0]))
            forms.append(f"1{c}")
            arrays.append(np.where(s.to_numpy(), b"T", b"F") if c == "L" else s.to_numpy())
    rec = np.empty(len(pdf), dtype=np.dtype(fields))
    for (n, _), a in zip(fields, arrays):
        rec[n] = a
    def card(k, v):
        v = f"'{v:<8}'" if isinstance(v, str) else ("T" if v is True else str(v))
        return f"{k:<8}= {v:>20}".ljust(80).encode("ascii")
    def header(cs):
        h = b"".join(card(k, v) for k, v in cs) + b"END".ljust(80)
        return h + b" " * (-len(h) % BLOCK)
    prim = header([("SIMPLE", True), ("BITPIX", 8), ("NAXIS", 0), ("EXTEND", True)])
    ext = [("XTENSION", "BINTABLE"), ("BITPIX", 8), ("NAXIS", 2), ("NAXIS1", rec.dtype.itemsize),
           ("NAXIS2", len(pdf)), ("PCOUNT", 0), ("GCOUNT", 1), ("TFIELDS", len(fields))]
    for i, ((n, _), f) in enumerate(zip(fields, forms), 1):
        ext += [(f"TTYPE{i}", n), (f"TFORM{i}", f)]
    data = rec.tobytes()
    return prim + header(ext) + data + b"\0" * (-len(data) % BLOCK)


def list_survey_files(spark: SparkSession, base: str, kind: str = "HEAD") -> DataFrame:
    """Files of one kind under ``base`` with their file number as written; when
    a plain file and its ``.gz`` twin exist in one directory, the plain file
    wins. A file of the kind whose name has no number is an error."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .option("pathGlobFilter", f"*_{kind}.FITS*").load(base).select("path"))
    num = F.regexp_extract("path", FILE_NUM, 1)
    num = F.when(num == "", F.raise_error(F.concat(F.lit("no file number in "), F.col("path")))).otherwise(num)
    f = files.select("path", num.alias("file_num"),
                     F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("__dir"),
                     F.col("path").endswith(".gz").alias("is_gz"))
    # twins are the same file number in the same directory (one row per file)
    w = Window.partitionBy("__dir", "file_num").orderBy("is_gz", "path")
    return f.withColumn("__r", F.row_number().over(w)).filter("__r = 1").drop("__r", "is_gz", "__dir")


def _probe_schema(spark: SparkSession, path: str) -> T.StructType:
    head = (spark.read.format("binaryFile").load(path)
            .select(F.substring("content", 1, BLOCK * 40).alias("h")).first()["h"])
    return spark_schema(bytes(head))


_WIDER = [T.ShortType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType()]


def merge_schemas(schemas: list[T.StructType]) -> T.StructType:
    """All columns of all schemas; numbers of different types take the wider one."""
    out: dict[str, T.DataType] = {}
    for f in (f for s in schemas for f in s.fields):
        have = out.setdefault(f.name, f.dataType)
        if have != f.dataType:
            if have not in _WIDER or f.dataType not in _WIDER:
                raise ValueError(f"column {f.name} is {have.simpleString()} in one class and {f.dataType.simpleString()} in another")
            out[f.name] = max(have, f.dataType, key=_WIDER.index)
    return T.StructType([T.StructField(n, t) for n, t in out.items()])


def _read_tables(spark: SparkSession, files: DataFrame, columns: list[str] | None,
                 with_row_idx: bool, chunk: int) -> DataFrame:
    paths = [r["path"] for r in files.select("path").orderBy("path").collect()]   # file names only
    if not paths:
        raise FileNotFoundError("no survey files found")
    firsts: dict[str, str] = {}
    for p in paths:
        firsts.setdefault(p.rsplit("/", 1)[0], p)
    full = merge_schemas([_probe_schema(spark, p) for p in firsts.values()])      # one header per class directory
    known = {f.name for f in full.fields}
    keep = [f for f in full.fields if columns is None or f.name in columns]
    out_fields = ([T.StructField("row_idx", T.LongType(), False)] if with_row_idx else []) + keep + \
        [T.StructField("file_num", T.StringType()), T.StructField("filename", T.StringType()),
         T.StructField("dirname", T.StringType())]
    schema = T.StructType(out_fields)
    names = [f.name for f in keep]

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path, content in zip(b["path"], b["content"]):
                arr, cols = bintable_records(bytes(content))
                m = re.search(FILE_NUM, path)
                odd = [n for n, _, _ in cols if n not in known]
                if odd:
                    raise ValueError(f"{path} has columns that the first file of its class lacks: {odd}")
                for lo in range(0, max(len(arr), 1), chunk):
                    # only one chunk is converted at a time
                    part = records_to_pandas(arr[lo:lo + chunk], cols, names)
                    for n in names:                      # a column that this class does not have
                        if n not in part.columns:
                            part[n] = pd.Series([None] * len(part), dtype=object)
                    part = part[names]
                    if with_row_idx:
                        part.insert(0, "row_idx", np.arange(lo, lo + len(part), dtype=np.int64))
                    part["file_num"] = m.group(1) if m else None
                    part["filename"] = path.rsplit("/", 1)[-1]
                    part["dirname"] = path.rsplit("/", 1)[0]
                    yield part

    # the binary source packs small files into a task and gives a large file its
    # own; the decoder holds one file at a time and yields bounded chunks
    raw = spark.read.format("binaryFile").load(paths).select("path", "content")
    return raw.mapInPandas(decode, schema)


def read_head(spark: SparkSession, base: str, drop: list[str] | None = None,
              chunk: int = 500_000) -> DataFrame:
    """SRC3: union of the HEAD files under ``base`` (plain beats ``.gz``),
    SNID as long, strings trimmed, uninformative columns dropped, plus
    ``file_num``, ``survey_dir`` (file numbers repeat in every class folder) and ``head_filename``."""
    files = list_survey_files(spark, base, "HEAD")
    df = _read_tables(spark, files, None, False, chunk)
    if "SNID" in df.columns and dict(df.dtypes)["SNID"] == "string":
        df = df.withColumn("SNID", F.trim("SNID").cast("long"))
    return (df.drop(*(drop if drop is not None else HEAD_DROP_COLUMNS)).withColumnRenamed("dirname", "survey_dir")
            .withColumnRenamed("filename", "head_filename"))


def read_phot(spark: SparkSession, base: str, columns: list[str] | None = None,
              chunk: int = 500_000) -> DataFrame:
    """SRC4: photometry rows of every PHOT file with their 0-based ``row_idx``
    in the file (needed by ``assign_object_ids``), ``file_num`` and ``survey_dir``; by default
    the 13 survey columns (those present)."""
    files = list_survey_files(spark, base, "PHOT")
    cols = columns if columns is not None else PHOT_COLUMNS
    return _read_tables(spark, files, cols, True, chunk).drop("filename").withColumnRenamed("dirname", "survey_dir")


def _with_class(df: DataFrame, prefix: str) -> DataFrame:
    return df.withColumn("class", F.regexp_extract("dirname", "/" + re.escape(prefix) + "([^/]+)$", 1))


def convert_to_parquet(spark: SparkSession, base: str, out: str, prefix: str = "",
                       phot_columns: list[str] | None = None, truth: DataFrame | None = None,
                       key: str = "SNID", mode: str = "overwrite") -> None:
    """Every class directory (``<prefix><class>``) under ``base``: HEAD and PHOT
    tables -> object ids (range join on class, file and pointers) -> nested
    curves -> joined with HEAD (and object truth, when given) -> one Parquet
    dataset partitioned by class. One Spark job over all classes."""
    from skyflux.operators.lightcurves import assign_object_ids, join_head, join_truth, nest_lightcurves
    from skyflux.sources.parquet import write_lightcurves
    hfiles = list_survey_files(spark, base, "HEAD")
    pfiles = list_survey_files(spark, base, "PHOT")
    head = _with_class(_read_tables(spark, hfiles, None, False, 500_000), prefix)
    if dict(head.dtypes).get(key) == "string":
        head = head.withColumn(key, F.trim(key).cast("long"))
    head = head.drop(*HEAD_DROP_COLUMNS).drop("dirname").withColumnRenamed("filename", "head_filename")
    cols = phot_columns if phot_columns is not None else PHOT_COLUMNS
    phot = _with_class(_read_tables(spark, pfiles, cols, True, 500_000), prefix).drop("filename", "dirname")
    curves = assign_object_ids(phot, head, key=key, file=["class", "file_num"])
    nested = nest_lightcurves(curves.drop("file_num", "row_idx"), ["class", key])     # an id may occur in two classes
    full = join_head(nested, head, ["class", key])
    if truth is not None:
        full = join_truth(full, truth, key)
    write_lightcurves(full, out, partition="class", key=key, mode=mode)
