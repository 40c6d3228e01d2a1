"""A data source for folders of fetched files: a partition for each file, records in order, and a row that says what became of the file.

    formats.register(spark)
    spark.read.format("retail_files").option("kind", "dump").load("/landing/2001-06-27")

Kinds: ``dump`` (a JSON list of items, plain or gzip), ``callback`` (a JSON
object with ``items``, in or out of a callback), ``sheet`` (CSV with a banner and
a header) and ``sitemap`` (XML with ``loc`` elements). A broken file does not
stop the others: it gives its row alone. Paths may be of any file system that Arrow knows (local, hdfs, s3, gs).
"""

import csv
import gzip
import io
import json
import re
from collections.abc import Iterator

import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from pricewave.sources.tables import SHEET_HEADER

SCHEMA = "file string, pos int, body string, status string, error string, records int"
#: A file with fewer records is short: it says so beside its records, and a floor over a whole dump is a matter of its reader.
LEAST = {"dump": 1, "callback": 1, "sheet": 3, "sitemap": 1}


def _dump(text: str) -> list:
    found = json.loads(text)
    if not isinstance(found, list):
        raise ValueError(f"a dump is a list, this is {type(found).__name__}")
    return [json.dumps(x, ensure_ascii=False) for x in found]


def _callback(text: str) -> list:
    inside = re.search(r"\((.*)\)\s*;?\s*$", text, re.S)
    found = json.loads(inside.group(1) if inside else text)
    if not isinstance(found, dict):
        raise ValueError(f"a callback holds an object, this is {type(found).__name__}")
    return [json.dumps(x, ensure_ascii=False) for x in found.get("items") or []]


def _sheet(text: str) -> list:
    rows = list(csv.reader(io.StringIO(text)))
    if len(rows) > 1 and tuple(c.strip() for c in rows[1][: len(SHEET_HEADER)]) != SHEET_HEADER:
        raise ValueError(f"header begins with {rows[1][: len(SHEET_HEADER)]}, not with {list(SHEET_HEADER)}")
    return [json.dumps(r, ensure_ascii=False) for r in rows]


def _sitemap(text: str) -> list:
    if "<" not in text:
        raise ValueError("no XML")
    return re.findall(r"<loc>(.*?)</loc>", text, re.S)


_KINDS = {"dump": _dump, "callback": _callback, "sheet": _sheet, "sitemap": _sitemap}


class _File(InputPartition):
    def __init__(self, path: str) -> None:
        self.path = path


class _Reader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.kind, self.least = options.get("kind", ""), options.get("least")
        if self.kind not in _KINDS:
            raise ValueError(f"kind must be one of {', '.join(_KINDS)}")
        self.files, self.root = pyarrow.fs.FileSystem.from_uri(options["path"])

    def partitions(self) -> list[InputPartition]:
        info = self.files.get_file_info(self.root)
        if info.type == pyarrow.fs.FileType.File:
            return [_File(self.root)]
        found = self.files.get_file_info(pyarrow.fs.FileSelector(self.root))
        return [_File(f.path) for f in sorted(found, key=lambda f: f.path) if f.is_file and not f.base_name.startswith((".", "_"))]

    def read(self, partition: _File) -> Iterator[tuple]:
        try:
            with self.files.open_input_stream(partition.path, compression=None) as stream:
                raw = stream.read()
            records = _KINDS[self.kind]((gzip.decompress(raw) if raw[:2] == b"\x1f\x8b" else raw).decode("utf-8"))
        except Exception as e:  # noqa: BLE001  whatever is wrong with a file, the others are read
            yield partition.path, None, None, "failed", f"{type(e).__name__}: {e}"[:300], 0
            return
        for pos, body in enumerate(records):
            yield partition.path, pos, body, None, None, None
        least = int(self.least) if self.least else LEAST[self.kind]
        yield partition.path, None, None, "success" if len(records) >= least else "no_data", None, len(records)


class RetailFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "retail_files"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        options = dict(self.options)
        if "://" not in options["path"]:
            options["path"] = "file://" + options["path"]
        return _Reader(options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(RetailFiles)


def records(read: DataFrame) -> DataFrame:
    """(file, pos, body): what the files hold; of files that failed or fell short nothing."""
    good = read.where("status = 'success'").select(F.col("file").alias("_good"))
    return read.where("status IS NULL").join(good, F.col("file") == F.col("_good"), "left_semi").select("file", "pos", "body")


def outcomes(read: DataFrame) -> DataFrame:
    """(file, status, error, records), a row for each file."""
    return read.where("status IS NOT NULL").select("file", "status", "error", "records")
