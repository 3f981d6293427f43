"""Geometry text (input files, XYZ) as structures, by built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

_ATOM = r"^\s*([A-Z][a-z]?)\s+([-+0-9.eE]+)\s+([-+0-9.eE]+)\s+([-+0-9.eE]+)\s*$"
_HEAD = r"(?m)^\s*\*\s*xyz\s+(-?[0-9]+)\s+([0-9]+)"


def _atoms(lines: Column) -> Column:
    rows = F.filter(lines, lambda line: line.rlike(_ATOM))
    return F.transform(
        rows,
        lambda line: F.struct(
            F.regexp_extract(line, _ATOM, 1).alias("elem"), *[F.regexp_extract(line, _ATOM, k).try_cast("double").alias(c) for k, c in ((2, "x"), (3, "y"), (4, "z"))]
        ),
    )


def parse_input(content: Column) -> Column:
    """(charge, spin, molecule) of an input text with a ``*xyz charge multiplicity`` block; null without one."""
    block = F.regexp_extract(content, r"(?s)\*\s*xyz[^\n]*\n(.*?)\n?\s*\*\s*(?:\n|$)", 1)
    return F.when(
        content.rlike(_HEAD),
        F.struct(
            F.regexp_extract(content, _HEAD, 1).try_cast("int").alias("charge"), F.regexp_extract(content, _HEAD, 2).try_cast("int").alias("spin"), _atoms(F.split(block, "\r?\n")).alias("molecule")
        ),
    )


def parse_xyz(content: Column) -> Column:
    """(n_atoms, comment, molecule) of an XYZ text; null if its first line is no number."""
    lines = F.split(content, "\r?\n")
    n = F.trim(lines[0]).try_cast("int")
    return F.when(n.isNotNull(), F.struct(n.alias("n_atoms"), F.get(lines, F.lit(1)).alias("comment"), _atoms(F.slice(lines, F.lit(3), F.greatest(n, F.lit(0)))).alias("molecule")))


def write_xyz(molecule: Column, comment: Column) -> Column:
    """The XYZ text of a molecule."""
    lines = F.transform(molecule, lambda a: F.format_string("%s %.6f %.6f %.6f", a["elem"], a["x"], a["y"], a["z"]))
    return F.concat_ws("\n", F.size(molecule).cast("string"), comment, F.array_join(lines, "\n"))


def write_input(molecule: Column, charge: Column, spin: Column, keywords: str) -> Column:
    """An input text with the molecule in a ``*xyz`` block."""
    lines = F.transform(molecule, lambda a: F.format_string("%s %.6f %.6f %.6f", a["elem"], a["x"], a["y"], a["z"]))
    return F.concat(F.lit(f"! {keywords}\n*xyz "), charge.cast("string"), F.lit(" "), spin.cast("string"), F.lit("\n"), F.array_join(lines, "\n"), F.lit("\n*\n"))


class _Archive(InputPartition):
    def __init__(self, path: str):
        self.path = path


class XyzArchiveReader(DataSourceReader):
    """One partition per archive, members streamed."""

    def __init__(self, options: dict):
        self.options = options

    def partitions(self) -> list[InputPartition]:
        import glob

        return [_Archive(p) for p in sorted(glob.glob(self.options["path"]))]

    def read(self, partition: _Archive):
        import tarfile

        with tarfile.open(partition.path, "r|*") as tar:
            for member in tar:
                if member.isfile() and member.name.endswith((".xyz", ".sdf", ".inp")):
                    yield partition.path, member.name, tar.extractfile(member).read().decode("utf-8", "replace")


class XyzArchives(DataSource):
    """``spark.read.format("molecule_archives")``: (archive, name, content) of tar archives (any compression)."""

    @classmethod
    def name(cls) -> str:
        return "molecule_archives"

    def schema(self) -> str:
        return "archive string, name string, content string"

    def reader(self, schema) -> DataSourceReader:
        return XyzArchiveReader(self.options)
