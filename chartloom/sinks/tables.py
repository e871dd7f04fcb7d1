"""The three stored tables and the timeline view."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartloom.operators.timeline import timeline, timeline_sql
from chartloom.schemas import TABLES, TIMELINE_VIEW
from chartloom.sinks.versions import Part, Version, Versions

SEGMENT = "_segment"


def defaults() -> dict[str, Column]:
    return {"created_at": F.current_timestamp()}


def fit(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project by name to ``schema``: wanted columns that exist, the rest as default or NULL."""
    given, filled = set(df.columns), defaults()
    return df.select(
        *[
            (F.col(f.name) if f.name in given else filled.get(f.name, F.lit(None)))
            .cast(f.dataType)
            .alias(f.name)
            for f in schema
        ]
    )


class Reader:
    """Tables of one version."""

    def __init__(self, spark: SparkSession, root: str, schemas: dict[str, T.StructType]):
        self.spark, self.root, self.schemas = spark, root.rstrip("/"), schemas

    def version(self) -> Version:
        raise NotImplementedError

    def parts(self, name: str) -> tuple[Part, ...]:
        return self.version().tables.get(name, ())

    def read(self, name: str) -> DataFrame:
        """All rows of a table; a table that was never written has none."""
        return self.read_parts(name, self.parts(name))

    def read_parts(self, name: str, parts: tuple[Part, ...]) -> DataFrame:
        """The rows of some parts; plain ones are one scan."""
        schema = self.schemas[name]
        plain = [f"{self.root}/{p.path}" for p in parts if not p.segmented]
        frames = [self.spark.read.schema(schema).parquet(*plain)] if plain else []
        for p in parts:
            if p.segmented:
                rows = self.spark.read.schema(segmented(schema)).parquet(f"{self.root}/{p.path}")
                frames.append(rows.where(~F.col(SEGMENT).isin(*p.without)).drop(SEGMENT))
        return reduce(DataFrame.unionByName, frames) if frames else self.spark.createDataFrame([], schema)


def segmented(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(SEGMENT, T.IntegerType())])


class Change(Reader):
    """Tables as they will be: what is written here is in no version until ``publish``."""

    def __init__(self, tables: Tables):
        super().__init__(tables.spark, tables.root, tables.schemas)
        self.store, self.base = tables.store, tables.version()
        self.tables = dict(self.base.tables)

    def version(self) -> Version:
        return Version(self.base.number + 1, self.tables)

    def write(self, name: str, df: DataFrame) -> Part:
        """Store rows in a folder of their own that no table has yet."""
        part = Part(self.store.new_folder(name))
        fit(df, self.schemas[name]).write.parquet(f"{self.root}/{part.path}")
        return part

    def replace(self, name: str, df: DataFrame) -> None:
        """Reset and reload; ``df`` may read the table as it was."""
        self.tables[name] = (self.write(name, df),)

    def append(self, name: str, df: DataFrame) -> None:
        self.tables[name] = (*self.parts(name), self.write(name, df))

    def publish(self) -> int:
        """Make this the newest version, all tables at once; its number."""
        return self.store.publish(self.base, self.tables).number

    def __enter__(self) -> Change:
        return self

    def __exit__(self, kind, *_) -> None:
        if kind is None:
            self.publish()


class Tables(Reader):
    """Parquet tables below one root folder, in versions (see ``sinks.versions``); the newest one unless
    a number is given. Every change of one or more tables is one new version."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        number: int | None = None,
        schemas: dict[str, T.StructType] | None = None,
    ):
        super().__init__(spark, root, schemas or TABLES)
        self.store, self.number = Versions(spark, self.root), number

    def version(self) -> Version:
        return self.store.read(self.number)

    def pinned(self) -> Tables:
        """These tables as they are now, whatever is published later."""
        return Tables(self.spark, self.root, self.version().number, self.schemas)

    def change(self) -> Change:
        """Several writes for one version: published at the end of a ``with`` block, if it ends well."""
        return Change(self)

    def append(self, name: str, df: DataFrame) -> None:
        with self.change() as new:
            new.append(name, df)

    def replace(self, name: str, df: DataFrame) -> None:
        """Reset and reload."""
        with self.change() as new:
            new.replace(name, df)

    def reset(self) -> None:
        """All tables empty."""
        with self.change() as new:
            for name in self.schemas:
                new.replace(name, self.spark.createDataFrame([], self.schemas[name]))

    def compact(self, *names: str) -> None:
        """Write tables that consist of several or of segmented folders into one folder each."""
        with self.change() as new:
            for name in names or self.schemas:
                new.replace(name, new.read(name))

    def path(self, name: str) -> str:
        """The folder of a table that is one folder; written into one first if it is not."""
        if len(self.parts(name)) != 1 or self.parts(name)[0].segmented:
            self.compact(name)
        return f"{self.root}/{self.parts(name)[0].path}"

    def declare(self, database: str = "default") -> None:
        """Typed tables in the session catalog, over the folders of the newest version. A later version is
        seen there once this is called again."""
        for name, schema in self.schemas.items():
            columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
            path = self.path(name)
            self.spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
            self.spark.sql(f"CREATE TABLE {database}.{name} ({columns}) USING parquet LOCATION '{path}'")

    def create_lasting_view(self, database: str = "default") -> None:
        """The timeline as a view in the catalog, over declared tables, for any later session."""
        parts = ("fhir_patients", "fhir_observations", "terminology_lookup")
        people, readings, terms = (f"{database}.{name}" for name in parts)
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {database}.{TIMELINE_VIEW} AS {timeline_sql(people, readings, terms)}"
        )

    def timeline(self) -> DataFrame:
        now = self.pinned()
        return timeline(
            now.read("fhir_patients"), now.read("fhir_observations"), now.read("terminology_lookup")
        )

    def create_view(self) -> None:
        self.timeline().createOrReplaceTempView(TIMELINE_VIEW)
