"""A data source over corpora in folders: root/repository/config/split/*.parquet, in local or mounted storage or any that pyarrow's file systems know.

    spark.dataSource.register(CorpusSource)
    spark.read.format("corpus").option("root", ...).option("repository", "owner/name").load().where("split = 'train'")

The columns are those of the files, and config and split. Each file is a partition; a filter on config
or split is taken up by the reader, so files that it excludes are neither opened nor tasks. A file that can't be read,
or whose columns differ, is left out with a warning when the source is planned. Filters are taken up where
`spark.sql.python.filterPushdown.enabled` is set; else Spark applies them to the rows.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition
from pyspark.sql.types import StringType, StructField, StructType

PUSHDOWN = ("spark.sql.python.filterPushdown.enabled", "true")


class CorpusFile(InputPartition):
    def __init__(self, path: str, config: str, split: str):
        self.path, self.config, self.split = path, config, split


def _system(root: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(root) if "://" in root or root.startswith("file:") else (fs.LocalFileSystem(), root)


class CorpusSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "corpus"

    def files(self) -> list[CorpusFile]:
        from pyarrow import fs

        system, root = _system(self.options["root"])
        top = f"{root.rstrip('/')}/{self.options['repository']}"
        found = system.get_file_info(fs.FileSelector(top, recursive=True, allow_not_found=True))
        parts = [(x.path, x.path[len(top) + 1 :].split("/")) for x in found if x.is_file and x.path.endswith(".parquet")]
        bare = lambda x: x.rpartition("=")[2]  # noqa: E731  folders may be named config=..., split=...
        return [CorpusFile(path, bare(p[0]), bare(p[1])) for path, p in sorted(parts) if len(p) == 3]

    def schema(self) -> StructType:
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import from_arrow_schema

        system, _ = _system(self.options["root"])
        for f in self.files():
            try:
                own = from_arrow_schema(pq.read_schema(f.path, filesystem=system))
            except Exception as e:
                warnings.warn(f"{f.path} is left out: {str(e)[:200]}", stacklevel=2)
                continue
            return StructType([*(x for x in own.fields if x.name not in ("config", "split")), StructField("config", StringType()), StructField("split", StringType())])
        return StructType([StructField("config", StringType()), StructField("split", StringType())])

    def reader(self, schema: StructType) -> CorpusReader:
        return CorpusReader(self, schema)


class CorpusReader(DataSourceReader):
    def __init__(self, source: CorpusSource, schema: StructType):
        self.files, self.root, self.columns = source.files(), source.options["root"], schema
        self.wanted: dict[str, set] = {}

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if isinstance(f, EqualTo | In) and f.attribute in (("config",), ("split",)):
                values = {f.value} if isinstance(f, EqualTo) else set(f.value)
                name = f.attribute[0]
                self.wanted[name] = self.wanted.get(name, values) & values
            else:
                yield f

    def partitions(self) -> list[CorpusFile]:
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import to_arrow_schema

        system, _ = _system(self.root)
        own = to_arrow_schema(StructType(self.columns.fields[:-2]))
        out = []
        for f in self.files:
            if all(getattr(f, name) in values for name, values in self.wanted.items()):
                try:
                    there = pq.read_schema(f.path, filesystem=system)
                    differ = [x.name for x in own if x.name not in there.names or not there.field(x.name).type.equals(x.type)]
                except Exception as e:
                    differ = [str(e)[:200]]
                if differ:
                    warnings.warn(f"{f.path} is left out: {', '.join(differ)}", stacklevel=2)
                else:
                    out.append(f)
        return out

    def read(self, partition: CorpusFile | None):
        import pyarrow as pa
        import pyarrow.parquet as pq

        if partition is None:  # Spark's one partition of a source that has none
            return
        system, _ = _system(self.root)
        names = [x.name for x in self.columns.fields[:-2]]
        with system.open_input_file(partition.path) as source:
            for batch in pq.ParquetFile(source).iter_batches(columns=names):
                more = [pa.array([x] * batch.num_rows, pa.string()) for x in (partition.config, partition.split)]
                yield pa.RecordBatch.from_arrays([batch.column(n) for n in names] + more, names=[*names, "config", "split"])
