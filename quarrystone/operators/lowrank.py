"""Missing cells filled by a low-rank model of all records.

Every record is a row of a matrix of encoded cells: numbers, transformed and
scaled, their coarse bins, and one column per category. Alternating least
squares learns row and column factors from the cells that are known; a missing
cell is decoded from its row's factors into a valid value and marked.

Row factors are never stored. A pass over the table solves each batch's row
factors from the current column factors (rows with the same cells missing
share one solve) and adds up what the columns' normal equations need: sums
whose size depends on the number of columns and patterns only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from quarrystone.functions.elements import SYMBOLS

#: name -> (forward, backward, the same forward in SQL over {x})
TRANSFORMS = {
    "log": (lambda x: np.log(np.maximum(x, 1e-12)), np.exp, "ln(greatest({x}, 1e-12D))"),
    "log1p": (lambda x: np.log1p(1e3 * np.maximum(x, 0)), lambda y: np.expm1(y) / 1e3, "ln(1 + 1e3D * greatest({x}, 0D))"),
    "asinh": (np.arcsinh, np.sinh, "signum({x}) * asinh(abs({x}))"),  # asinh of large negative numbers loses all digits
}


@dataclass(frozen=True)
class NumberField:
    """A numeric column; usable values are finite, in [low, high] (above ``low`` if ``open_low``)."""

    name: str
    transform: str
    low: float = -np.inf
    high: float = np.inf
    open_low: bool = False
    fill: bool = False
    bins: int = 0

    def usable(self) -> Column:
        x = F.col(self.name).cast("double")
        above = x > F.lit(self.low) if self.open_low else x >= F.lit(self.low)
        return F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")) & above & (x <= F.lit(self.high)), F.lit(False))

    def known(self, x: np.ndarray) -> np.ndarray:
        return np.isfinite(x) & ((x > self.low) if self.open_low else (x >= self.low)) & (x <= self.high)


@dataclass(frozen=True)
class CategoryField:
    """A text column with values from ``values``, case and outer U+0020 ignored.

    Asked only of rows whose ``asked_col`` matches ``asked_pattern``.
    """

    name: str
    values: tuple[str, ...]
    asked_col: str
    asked_pattern: str


@dataclass
class Model:
    mean: dict[str, float]
    scale: dict[str, float]
    edges: dict[str, np.ndarray]
    categories: list[str]
    factors: np.ndarray | None = None


@dataclass(frozen=True)
class LowRankFill:
    """Fields and parameters of the fill; see ``fill``.

    ``reach``: numbers farther from the mean than so many deviations (of the
    transformed column) pull on the factors as if they were that far; they
    stay as they are in the table, and no fill lies beyond.
    """

    numbers: tuple[NumberField, ...]
    category: CategoryField
    rank: int = 20
    rounds: int = 6
    ridge: float = 0.005
    bin_weight: float = 0.5
    reach: float = 8.0
    seed: int = 17
    mark: str = "_filled"

    @property
    def filled_numbers(self) -> list[NumberField]:
        return [n for n in self.numbers if n.fill]

    # --- encoding -----------------------------------------------------------------
    def _groups(self, model: Model) -> list[tuple[str, int]]:
        """The blocks of columns that are missing together, with their widths."""
        return [(n.name, 1 + n.bins) for n in self.numbers] + [(self.category.name, len(model.categories)), ("asked", 1)]

    def _weights(self, model: Model) -> np.ndarray:
        parts = [np.concatenate([[1.0], np.full(n.bins, self.bin_weight)]) for n in self.numbers]
        return np.concatenate([*parts, np.ones(len(model.categories)), [1.0]])

    def _asked(self, batch: pa.RecordBatch) -> np.ndarray:
        hit = pc.match_substring_regex(batch.column(self.category.asked_col), self.category.asked_pattern)
        return pc.fill_null(hit, False).to_numpy(zero_copy_only=False)

    def _codes(self, batch: pa.RecordBatch, categories: list[str]) -> np.ndarray:
        """The place of each row's category in ``categories``, -1 if it is none of them."""
        text = pc.utf8_lower(pc.utf8_trim(batch.column(self.category.name).cast(pa.string()), " "))
        found = pc.index_in(text, value_set=pa.array([c.lower() for c in categories], pa.string()))
        return pc.fill_null(found, -1).to_numpy(zero_copy_only=False)

    def _encode(self, batch: pa.RecordBatch, model: Model) -> tuple[np.ndarray, np.ndarray, dict[str, np.ndarray]]:
        """Cells, an integer per row with a bit per known block, and which cells to fill."""
        n = batch.num_rows
        blocks, known, missing = [], np.zeros(n, np.int64), {}
        for bit, f in enumerate(self.numbers):
            x = batch.column(f.name).cast(pa.float64()).to_numpy(zero_copy_only=False)
            ok = f.known(x)
            if f.fill:
                missing[f.name] = ~ok
            y = np.where(ok, (TRANSFORMS[f.transform][0](np.where(ok, x, 1.0)) - model.mean[f.name]) / model.scale[f.name], 0.0)
            block = np.zeros((n, 1 + f.bins))
            block[:, 0] = np.clip(y, -self.reach, self.reach)
            if f.bins:
                place = np.searchsorted(model.edges[f.name], y)
                block[np.arange(n), 1 + place] = ok
            blocks.append(block)
            known |= ok.astype(np.int64) << bit
        asked = self._asked(batch)
        codes = np.where(asked, self._codes(batch, model.categories), -1)
        missing[self.category.name] = asked & (codes < 0)
        block = np.zeros((n, len(model.categories)))
        block[np.flatnonzero(codes >= 0), codes[codes >= 0]] = 1.0
        blocks += [block, asked[:, None].astype(float)]
        bit = len(self.numbers)
        known |= (((codes >= 0) | ~asked).astype(np.int64) << bit) | (1 << (bit + 1))
        return np.hstack(blocks), known, missing

    def _columns_of(self, pattern: int, model: Model) -> np.ndarray:
        return np.repeat([bool(pattern >> b & 1) for b in range(len(self._groups(model)))], [w for _, w in self._groups(model)])

    def _row_factors(self, cells: np.ndarray, known: np.ndarray, model: Model) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """Per pattern of known blocks: (pattern, its rows, its columns, the rows' factors)."""
        weights = self._weights(model)
        for pattern in np.unique(known):
            rows, cols = np.flatnonzero(known == pattern), self._columns_of(int(pattern), model)
            v = model.factors[cols]
            wv = v * weights[cols, None]
            solve = np.linalg.inv(v.T @ wv + self.ridge * np.eye(self.rank))
            yield int(pattern), rows, cols, cells[np.ix_(rows, np.flatnonzero(cols))] @ wv @ solve

    # --- fitting ------------------------------------------------------------------
    def prepare(self, df: DataFrame) -> Model:
        """Means, spreads, bins and the categories that occur, in one pass."""
        aggs = []
        for f in self.numbers:
            y = F.when(f.usable(), F.expr(TRANSFORMS[f.transform][2].format(x=f"cast(`{f.name}` as double)")))
            aggs += [F.avg(y).alias(f"m_{f.name}"), F.stddev_pop(y).alias(f"s_{f.name}"), F.min(y).alias(f"l_{f.name}"), F.max(y).alias(f"h_{f.name}")]
        c = self.category
        symbol = F.lower(F.trim(c.name))
        valid = symbol.isin([v.lower() for v in c.values]) & F.col(c.asked_col).rlike(c.asked_pattern)
        row = df.agg(*aggs, F.array_sort(F.collect_set(F.when(valid, symbol))).alias("categories")).first()
        spelled = {v.lower(): v for v in c.values}
        model = Model({}, {}, {}, [spelled[x] for x in row["categories"]] or [c.values[0]])
        for f in self.numbers:
            mean = row[f"m_{f.name}"]
            model.mean[f.name] = 0.0 if mean is None else mean
            model.scale[f.name] = row[f"s_{f.name}"] or 1.0
            low, high = (((row[k] if row[k] is not None else 0.0) - model.mean[f.name]) / model.scale[f.name] for k in (f"l_{f.name}", f"h_{f.name}"))
            model.edges[f.name] = np.linspace(low, high, f.bins + 1)[1:-1] if f.bins else np.zeros(0)
        return model

    def fit(self, df: DataFrame) -> Model:
        """Column factors after ``rounds`` passes over all rows."""
        model = self.prepare(df)
        width, r = sum(w for _, w in self._groups(model)), self.rank
        model.factors = np.random.default_rng(self.seed).normal(0, 0.3, (width, r))
        used = df.select(*dict.fromkeys([*(f.name for f in self.numbers), self.category.name, self.category.asked_col]))
        for _ in range(self.rounds):
            sums = {p["pos"]: p["total"] for p in used.mapInArrow(self._sums(model), "pos bigint, value double").groupBy("pos").agg(F.sum("value").alias("total")).collect()}
            if not sums:
                break
            n_rows = sums.pop(_ROWS)
            gram, cross, spread = np.zeros((width, r, r)), np.zeros((width, r)), np.zeros((r, r))
            for pos, total in sums.items():
                pattern, at = divmod(pos, _SPAN)
                if pattern == 0:
                    cross[at // r, at % r] = total
                else:
                    gram[self._columns_of(pattern, model), at // r, at % r] += total
                    spread[at // r, at % r] += total
            ridge = 0.06 * self.ridge * (1 + np.trace(gram, axis1=1, axis2=2) / r)
            factors = np.linalg.solve(gram + ridge[:, None, None] * np.eye(r), cross[:, :, None])[:, :, 0]
            # row factors of unit covariance, else their ridge loses its force from round to round
            model.factors = factors @ np.linalg.cholesky(spread / n_rows + 1e-6 * np.eye(r))
        return model

    def _sums(self, model: Model):
        r = self.rank

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            grams: dict[int, np.ndarray] = {}
            cross = np.zeros((len(model.factors), r))
            n = 0.0
            for batch in batches:
                n += batch.num_rows
                cells, known, _ = self._encode(batch, model)
                for pattern, rows, cols, u in self._row_factors(cells, known, model):
                    grams[pattern] = grams.get(pattern, 0) + u.T @ u
                    cross[cols] += cells[np.ix_(rows, np.flatnonzero(cols))].T @ u
            if grams:
                pos = [[_ROWS], np.arange(cross.size)] + [p * _SPAN + np.arange(r * r) for p in grams]
                values = [[n], cross.ravel()] + [g.ravel() for g in grams.values()]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(pos)), pa.array(np.concatenate(values))], names=["pos", "value"])

        return run

    # --- filling ------------------------------------------------------------------
    def fill(self, df: DataFrame, model: Model | None = None) -> DataFrame:
        """``df`` with every cell of the filled fields usable, and a mark per field.

        Columns ``<field>_filled`` are true where the value was filled (any
        columns of these names are replaced). Usable values stay as they were,
        but for the category's case and blanks. Numbers are decoded into their
        valid range, categories into the one with the highest score among
        those that occur; where nothing at all is known of a field, its middle
        value stands in. Rows the category is not asked of keep it as it is.
        Repeated rows are filled alike. An empty table stays empty.
        """
        model = model or self.fit(df)
        marks = [f"{n.name}{self.mark}" for n in self.filled_numbers] + [f"{self.category.name}{self.mark}"]
        base = df.drop(*marks)
        schema = StructType(list(base.schema.fields) + [StructField(m, BooleanType()) for m in marks])
        starts = dict(zip([g for g, _ in self._groups(model)], np.cumsum([0] + [w for _, w in self._groups(model)])))
        categories, names = model.categories, base.columns

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                cells, known, missing = self._encode(batch, model)
                wanted = np.any(list(missing.values()), axis=0)
                decoded = {name: np.zeros(batch.num_rows) for name in missing}
                at = np.flatnonzero(wanted)
                first = starts[self.category.name]
                for _, rows, _, u in self._row_factors(cells[at], known[at], model):
                    for f in self.filled_numbers:
                        decoded[f.name][at[rows]] = u @ model.factors[starts[f.name]]
                    decoded[self.category.name][at[rows]] = np.argmax(u @ model.factors[first : first + len(categories)].T, axis=1)
                columns = {name: batch.column(name) for name in names}
                for f in self.filled_numbers:
                    x = batch.column(f.name).cast(pa.float64()).to_numpy(zero_copy_only=False)
                    y = TRANSFORMS[f.transform][1](np.clip(decoded[f.name], -self.reach, self.reach) * model.scale[f.name] + model.mean[f.name])
                    y = np.clip(np.nan_to_num(y, nan=1.0), max(f.low, 1e-9) if f.open_low else f.low, f.high)
                    columns[f.name] = pa.array(np.where(missing[f.name], y, x)).cast(batch.column(f.name).type)
                text = pc.utf8_trim(batch.column(self.category.name).cast(pa.string()), " ")
                codes, asked = self._codes(batch, list(self.category.values)), self._asked(batch)
                proper = pa.array(self.category.values).take(pa.array(np.maximum(codes, 0)))
                guess = pa.array(categories).take(pa.array(decoded[self.category.name].astype(np.int64)))
                gone = pa.array(missing[self.category.name])
                columns[self.category.name] = pc.if_else(gone, guess, pc.if_else(pa.array(asked & (codes >= 0)), proper, text))
                yield pa.RecordBatch.from_arrays([*columns.values(), *[pa.array(missing[m[: -len(self.mark)]]) for m in marks]], names=[*columns, *marks])

        return base.mapInArrow(run, schema)


#: Places of the sums: below _SPAN the cross sums, then _SPAN for each pattern's Gram matrix; _ROWS the row count.
_SPAN, _ROWS = 1 << 20, -1

#: The critical points of the test tables: what is filled, and what helps.
CRITICAL_POINTS = LowRankFill(
    numbers=(
        NumberField("density_all", "log", 0.0, 1e5, open_low=True, fill=True, bins=24),
        NumberField("ellip_e_dens", "log1p", 0.0, 1e3, fill=True),
        NumberField("eig_hess", "asinh", bins=24),
        NumberField("lap_e_density", "asinh", bins=24),
        NumberField("esp_total", "asinh", bins=24),
        NumberField("spin_density", "asinh"),
        NumberField("lagrangian_k", "asinh"),
        NumberField("eta", "asinh"),
    ),
    category=CategoryField("elem", tuple(SYMBOLS), "cp_key", r"^[0-9]+$"),
)


def latest_points(points: DataFrame, keys: tuple[str, ...] = ("record_key", "cp_key"), loaded_at: str = "loaded_at") -> DataFrame:
    """One row per point: of rows sent more than once the one loaded last.

    Ties in ``loaded_at`` are settled by the row's hash; nulls are earliest.
    """
    order = Window.partitionBy(*keys).orderBy(F.col(loaded_at).desc_nulls_last(), F.xxhash64(*[c for c in points.columns if c not in keys]))
    return points.withColumn("_place", F.row_number().over(order)).where(F.col("_place") == 1).drop("_place")


def filled_cells(filled: DataFrame, model: LowRankFill, keys: tuple[str, ...] = ("record_key", "cp_key")) -> DataFrame:
    """A row per filled cell: (keys, field)."""
    fields = [n.name for n in model.filled_numbers] + [model.category.name]
    marked = F.filter(F.array(*[F.when(F.col(f"{f}{model.mark}"), F.lit(f)) for f in fields]), lambda x: x.isNotNull())
    return filled.select(*keys, F.explode(marked).alias("field"))
