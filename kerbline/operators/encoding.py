"""Spark ML stages: derived features, encoding, scaling, assembly, hotspots."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexerModel, VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, Window, functions as F

from kerbline.columns import col, measured, numeric
from kerbline.functions import features
from kerbline.profile import ROAD, Profile
from kerbline.scale import attach_by_key, scratch_path, settle

LABEL_OUTPUT = "label"
FEATURES_OUTPUT = "features"
SCALED_OUTPUT = "numeric_scaled"
# Beyond this many values a category is indexed by a stored table.
DRIVER_CATEGORIES = 10_000
# One-hot columns and the label take a place in each vector for each value.
MOST_VECTOR_VALUES = 10_000


class _ColumnTransformer(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Appends one column computed from the input columns by an expression."""

    inputCols = Param(Params._dummy(), "inputCols", "input columns in order", TypeConverters.toListString)
    outputCol = Param(Params._dummy(), "outputCol", "output column", TypeConverters.toString)
    _inputs: tuple[str, ...] = ()
    _output = ""

    @keyword_only
    def __init__(self, *, inputCols=None, outputCol=None):
        super().__init__()
        self._setDefault(inputCols=list(self._inputs), outputCol=self._output)
        self._set(**self._input_kwargs)

    @keyword_only
    def setParams(self, *, inputCols=None, outputCol=None):
        return self._set(**self._input_kwargs)

    def getInputCols(self) -> list[str]:
        return self.getOrDefault(self.inputCols)

    def getOutputCol(self) -> str:
        return self.getOrDefault(self.outputCol)

    def _expression(self, *inputs):
        raise NotImplementedError

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn(self.getOutputCol(), self._expression(*[col(c) for c in self.getInputCols()]))


class RiskIndex(_ColumnTransformer):
    """Risk index from light, weather, surface, speed and road type."""

    _inputs = (ROAD.light, ROAD.weather, ROAD.surface, ROAD.speed, ROAD.road_type)
    _output = "danger_index"

    def _expression(self, *inputs):
        return features.risk_index(*inputs)


class VulnerableFlag(_ColumnTransformer):
    """Vulnerability flag from vehicle type and engine size."""

    _inputs = (ROAD.detail_type, ROAD.engine)
    _output = "vehicle_vulnerable"

    def _expression(self, *inputs):
        return features.vulnerable(*inputs)


class HotspotCluster(_ColumnTransformer):
    """Nearest hotspot centre from latitude and longitude."""

    _inputs = (ROAD.lat, ROAD.lon)
    _output = "accident_hotspot_cluster"

    def _expression(self, *inputs):
        return features.nearest_centre(*inputs)


class DensityBand(_ColumnTransformer):
    """Density band of the hotspot cluster."""

    _inputs = ("accident_hotspot_cluster",)
    _output = "location_density"

    def _expression(self, *inputs):
        return features.density_band(*inputs)


def add_spatial_features(df: DataFrame, lat: str = ROAD.lat, lon: str = ROAD.lon) -> DataFrame:
    """Append hotspot cluster and density band."""
    return DensityBand().transform(HotspotCluster(inputCols=[lat, lon]).transform(df))


def derived_stages(p: Profile = ROAD) -> list[Transformer]:
    return [
        RiskIndex(inputCols=[p.light, p.weather, p.surface, p.speed, p.road_type]),
        VulnerableFlag(inputCols=[p.detail_type, p.engine]),
        HotspotCluster(inputCols=[p.lat, p.lon]),
        DensityBand(),
    ]


def scaling_stages(p: Profile = ROAD) -> list:
    """Numeric vector (rows with a null are dropped) and its standardised form."""
    return [
        VectorAssembler(inputCols=list(p.scaled), outputCol="numeric_raw", handleInvalid="skip"),
        StandardScaler(inputCol="numeric_raw", outputCol=SCALED_OUTPUT, withMean=True, withStd=True),
    ]


def encoding_stages(p: Profile = ROAD, category_limit: int = DRIVER_CATEGORIES, extra: tuple[str, ...] = ()) -> tuple[list, list[str]]:
    """Index and one-hot stages, and the encoded columns in assembly order.

    All columns are counted in one pass over the rows. Unseen and missing
    categories take the last index; a missing label is an error. ``extra``
    columns are indexed only.
    """
    one_hot, indexed = list(p.one_hot), list(p.indexed)
    names = [*one_hot, *indexed, *extra]
    indexer = JointIndexer(
        inputCols=[*names, p.label],
        outputCols=[*[f"{c}_idx" for c in names], LABEL_OUTPUT],
        narrow=[*one_hot, p.label],
        strict=[p.label],
        limit=category_limit,
        most=MOST_VECTOR_VALUES,
    )
    stages: list = [indexer]
    if one_hot:
        # The indices carry their number of values, so this fit reads no rows.
        stages.append(OneHotEncoder(inputCols=[f"{c}_idx" for c in one_hot], outputCols=[f"{c}_ohe" for c in one_hot], handleInvalid="keep"))
    return stages, [f"{c}_ohe" for c in one_hot] + [f"{c}_idx" for c in indexed]


def assembly_stage(encoded: list[str], extra: list[str] | None = None) -> VectorAssembler:
    """The feature vector. Its inputs are never null: scaling has dropped such rows, indices and derived columns have a place for them.

    So nothing is skipped here; the test for it would compute every input a second time.
    """
    return VectorAssembler(inputCols=[SCALED_OUTPUT, *encoded, *(extra or [])], outputCol=FEATURES_OUTPUT, handleInvalid="error")


def build_stages(p: Profile = ROAD, include_derived: bool = False, category_limit: int = DRIVER_CATEGORIES) -> list:
    """All stages in order: derived features, scaling, encoding, assembly.

    The derived columns stay out of the feature vector unless asked for.
    """
    encoding, encoded = encoding_stages(p, category_limit, ("location_density",) if include_derived else ())
    stages = [*derived_stages(p), *scaling_stages(p), *encoding]
    extra = ["danger_index", "vehicle_vulnerable", "accident_hotspot_cluster", "location_density_idx"] if include_derived else []
    return [*stages, assembly_stage(encoded, extra)]


def build_feature_job(p: Profile = ROAD, include_derived: bool = False, category_limit: int = DRIVER_CATEGORIES) -> Pipeline:
    return Pipeline(stages=build_stages(p, include_derived, category_limit))


class ValueLimit(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Refuses columns whose values would fill the driver or the vectors; changes nothing."""

    inputCols = Param(Params._dummy(), "inputCols", "checked columns", TypeConverters.toListString)
    most = Param(Params._dummy(), "most", "values allowed", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCols=None, most=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        names, most = self.getOrDefault(self.inputCols), self.getOrDefault(self.most)
        if wide := oversized_categories(dataset, tuple(names), most):
            counts = dataset.agg(*[F.approx_count_distinct(col(n)).alias(n) for n in wide]).first()
            found = ", ".join(f"{n} (about {counts[n]})" for n in wide)
            raise ValueError(f"more than {most} values for a vector or label: {found}")
        return PipelineModel([])


class JointIndexer(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Category indices of many columns, fitted on one stored table of value counts.

    Same numbers as Spark's indexer: most frequent first, ties in value order.
    Columns of at most ``limit`` values keep them in the model, larger ones in a
    stored table; the fitted model is complete either way and saves, loads and
    transforms by itself. Missing and unseen values take the last index, but
    are an error in ``strict`` columns. ``narrow`` columns of more than ``most``
    values are refused.
    """

    inputCols = Param(Params._dummy(), "inputCols", "category columns", TypeConverters.toListString)
    outputCols = Param(Params._dummy(), "outputCols", "index columns", TypeConverters.toListString)
    narrow = Param(Params._dummy(), "narrow", "columns that take a place in a vector for each value", TypeConverters.toListString)
    strict = Param(Params._dummy(), "strict", "columns whose unknown values are an error", TypeConverters.toListString)
    limit = Param(Params._dummy(), "limit", "values kept in the model", TypeConverters.toInt)
    most = Param(Params._dummy(), "most", "values allowed in narrow columns", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None, narrow=None, strict=None, limit=None, most=None):
        super().__init__()
        self._setDefault(narrow=[], strict=[], limit=DRIVER_CATEGORIES, most=MOST_VECTOR_VALUES)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        names, outputs, narrow, strict, limit, most = (
            self.getOrDefault(x) for x in (self.inputCols, self.outputCols, self.narrow, self.strict, self.limit, self.most)
        )
        texts = [col(n).cast("string").alias(f"c{i}") for i, n in enumerate(names)]
        long = dataset.select(*texts).unpivot([], [f"c{i}" for i in range(len(names))], "column", "value")
        counts = settle(long.filter("value is not null").groupBy("column", "value").agg(F.count("*").alias("n")))
        # One row a column.
        sizes = {r["column"]: r["values"] for r in counts.groupBy("column").agg(F.count("*").alias("values")).collect()}
        size = {n: sizes.get(f"c{i}", 0) for i, n in enumerate(names)}
        if wide := [f"{n} ({size[n]})" for n in names if n in narrow and size[n] > most]:
            raise ValueError(f"more than {most} values for a vector or label: {', '.join(wide)}")
        # Narrow and strict columns need Spark's own model: its index carries the number of values.
        held = [n for n in names if size[n] <= limit or n in narrow or n in strict]
        labels: dict[str, list] = {f"c{names.index(n)}": [] for n in held}
        # Bounded: ``limit`` or ``most`` values a column.
        for r in counts.filter(F.col("column").isin(list(labels))).collect():
            # Ties stand in the order of code points, as in Spark's indexer and its sorts.
            labels[r["column"]].append((-r["n"], r["value"]))
        stages: list = []
        for i, (n, o) in enumerate(zip(names, outputs, strict=True)):
            if n in held:
                values = [v for _, v in sorted(labels[f"c{i}"])]
                stages.append(StringIndexerModel.from_labels(values, n, o, "error" if n in strict else "keep"))
            else:
                index = FrequencyIndex.from_counts(n, counts.filter(F.col("column") == f"c{i}").select("value", "n"))
                path = scratch_path(dataset.sparkSession, "categories")
                index.table.write.parquet(path)
                stages.append(CategoryTable(inputCol=n, outputCol=o, table=path))
        return PipelineModel(stages)


class CategoryTable(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Indices of one column by a stored table (value, index)."""

    inputCol = Param(Params._dummy(), "inputCol", "category column", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "index column", TypeConverters.toString)
    table = Param(Params._dummy(), "table", "path of the table, which must outlive the model", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, table=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        table = dataset.sparkSession.read.parquet(self.getOrDefault(self.table))
        return FrequencyIndex(self.getOrDefault(self.inputCol), table).transform(dataset, self.getOrDefault(self.outputCol))


class FrequencyIndex:
    """Category index as a table, for columns with too many values for a driver.

    Same numbers as an indexer stage: most frequent first, ties in value order,
    unseen and missing values get the number of known values.
    """

    def __init__(self, column: str, table: DataFrame):
        self.column, self.table = column, table

    @classmethod
    def fit(cls, df: DataFrame, column: str) -> FrequencyIndex:
        text = df.filter(col(column).isNotNull()).select(col(column).cast("string").alias("value"))
        return cls.from_counts(column, text.groupBy("value").agg(F.count("*").alias("n")))

    @classmethod
    def from_counts(cls, column: str, counts: DataFrame) -> FrequencyIndex:
        """From rows (value, n) with each value once."""
        # A row id taken after a range sort holds partition and place, so one
        # task never sees all values.
        ordered = counts.orderBy(F.desc("n"), "value").select(
            "value", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("row_id")
        )
        ordered = settle(ordered)
        earlier = Window.partitionBy(F.lit(1)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        starts = ordered.groupBy("part").agg(F.count("*").alias("size"), F.min("row_id").alias("first_id"))
        starts = starts.withColumn("start", F.coalesce(F.sum("size").over(earlier), F.lit(0)))
        # Bounded: one row per partition.
        placed = ordered.join(F.broadcast(starts), "part")
        index = (F.col("start") + F.col("row_id") - F.col("first_id")).cast("double")
        return cls(column, settle(placed.select("value", index.alias("index"))))

    def transform(self, df: DataFrame, output: str | None = None) -> DataFrame:
        output = output or f"{self.column}_idx"
        known = self.table.count()
        table = self.table.select(F.col("value").alias(self.column), F.col("index").alias(output))
        joined = attach_by_key(df, table, self.column, stored=True)
        return joined.withColumn(output, F.coalesce(col(output), F.lit(float(known))))


def oversized_categories(df: DataFrame, names: tuple[str, ...], limit: int) -> tuple[str, ...]:
    """Those columns with more than about ``limit`` distinct values (one pass)."""
    found = [n for n in names if n in df.columns]
    if not found:
        return ()
    row = df.agg(*[F.approx_count_distinct(col(n)).alias(f"d{i}") for i, n in enumerate(found)]).first()
    return tuple(n for i, n in enumerate(found) if row[f"d{i}"] > limit)


def fit_hotspots(df: DataFrame, lat: str, lon: str, k: int = 10, seed: int = 42, max_iter: int = 20) -> KMeansModel:
    """K-means on the located rows."""
    return KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol=FEATURES_OUTPUT).fit(_located(df, lat, lon))


def hotspot_table(model: KMeansModel, df: DataFrame, lat: str, lon: str) -> DataFrame:
    """Per cluster its centre, its rows and their percentage of all located rows."""
    counts = model.transform(_located(df, lat, lon)).groupBy("prediction").agg(F.count("*").alias("n"))
    rows = [(i, float(c[0]), float(c[1])) for i, c in enumerate(model.clusterCenters())]
    centres = df.sparkSession.createDataFrame(rows, "prediction int, centre_lat double, centre_lon double")
    # k rows, here and in the join.
    total = F.sum("n").over(Window.partitionBy(F.lit(1)))
    return counts.join(F.broadcast(centres), "prediction").withColumn("pct", F.round(F.col("n") / total * 100, 1))


def _located(df: DataFrame, lat: str, lon: str) -> DataFrame:
    points = df.select(numeric(lat).alias("__lat"), numeric(lon).alias("__lon"))
    points = points.filter(measured(F.col("__lat")) & measured(F.col("__lon")))
    return VectorAssembler(inputCols=["__lat", "__lon"], outputCol=FEATURES_OUTPUT).transform(points)


def vector_stats(df: DataFrame, vector: str = SCALED_OUTPUT) -> DataFrame:
    """Rows (position, mean, std) of a vector column."""
    from pyspark.ml.functions import vector_to_array
    from pyspark.ml.stat import Summarizer

    stats = df.select(Summarizer.metrics("mean", "std").summary(col(vector)).alias("s"))
    arrays = stats.select(vector_to_array("s.mean").alias("m"), vector_to_array("s.std").alias("d"))
    zipped = F.posexplode(F.arrays_zip("m", "d"))
    return arrays.select(zipped.alias("position", "z")).select("position", F.col("z.m").alias("mean"), F.col("z.d").alias("std"))


def written_check(df: DataFrame) -> DataFrame:
    """One row: rows, null feature vectors and null labels of a written result."""
    return df.agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col(FEATURES_OUTPUT).isNull()).alias("null_features"),
        F.count_if(F.col(LABEL_OUTPUT).isNull()).alias("null_labels"),
    )
