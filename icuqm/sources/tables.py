"""Find, read and conform source tables; write results."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from icuqm.functions.clinical import category, number
from icuqm.functions.time import localise


def resolve_table(spark: SparkSession, folder: str, name: str, fmt: str = "parquet") -> str | None:
    """Path of a table: exact file name, then any prefix, then any name that contains it.

    Listing goes through the file system of the path, so object stores work as local folders do.
    """
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(folder)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for pattern in (f"{name}.{fmt}", f"*{name}.{fmt}", f"*{name}*.{fmt}"):
        hits = fs.globStatus(jvm.org.apache.hadoop.fs.Path(root, pattern))
        found = sorted(str(h.getPath().toString()) for h in (hits or []))
        if found:
            return found[0]
    return None


def read_path(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """Parquet, or csv with a header, by suffix (S3). Csv columns are text unless a schema is given; ``conform`` types them."""
    if path.lower().endswith(".parquet"):
        return spark.read.parquet(path)
    reader = spark.read.option("header", True)
    return (reader.schema(schema) if schema else reader).csv(path)


def pick_column(df: DataFrame, candidates: Sequence[str]) -> str | None:
    """First candidate the table has."""
    return next((c for c in candidates if c in df.columns), None)


@dataclass(frozen=True)
class Field:
    """One wanted column: where it may come from and how it is cleaned."""

    name: str
    kind: str
    names: tuple[str, ...] = ()
    required: bool = True

    @property
    def candidates(self) -> tuple[str, ...]:
        return (self.name, *self.names)


_TYPES = {"id": "string", "category": "string", "label": "string", "number": "double", "time": "timestamp", "date": "date", "flag": "boolean"}


def conform(df: DataFrame, fields: Sequence[Field]) -> DataFrame:
    """Select, clean and type the wanted columns; absent optional ones become typed NULLs."""
    out = []
    for f in fields:
        source = pick_column(df, f.candidates)
        if source is None:
            if f.required:
                raise ValueError(f"no column for {f.name!r}; tried {f.candidates}")
            out.append(F.lit(None).cast(_TYPES[f.kind]).alias(f.name))
            continue
        c = F.col(source)
        match f.kind:
            case "category":
                clean = category(c)
            case "label":
                clean = F.nullif(F.trim(c.cast("string")), F.lit(""))
            case "number":
                clean = number(c)
            case "time":
                kind = df.schema[source].dataType.typeName()
                if kind == "string":
                    # text with an offset is an instant, text without one is local time
                    zoned = c.rlike("([Zz]|[+-][0-9]{2}:?[0-9]{2})$")
                    clean = F.when(zoned, F.try_to_timestamp(c)).otherwise(localise(c.try_cast("timestamp_ntz")))
                elif kind in ("timestamp_ntz", "date"):
                    clean = localise(c.cast("timestamp_ntz"))
                else:
                    clean = c.cast("timestamp")
            case "flag":
                clean = number(c.cast("string")) >= 1
                clean = F.coalesce(clean, c.cast("string").try_cast("boolean"), F.lit(False))
            case _:
                clean = c.cast(_TYPES[f.kind])
        out.append(clean.alias(f.name))
    return df.select(*out)


# The source tables and the columns the measures read.
SCHEMAS: dict[str, tuple[Field, ...]] = {
    "patient": (
        Field("patient_id", "id"),
        Field("birth_date", "time", required=False),
        Field("sex_category", "category", required=False),
        Field("race_category", "category", required=False),
        Field("ethnicity_category", "category", required=False),
        Field("death_dttm", "time", required=False),
    ),
    "hospitalization": (
        Field("hospitalization_id", "id"),
        Field("patient_id", "id"),
        Field("admission_dttm", "time", ("admit_dttm", "hospital_admission_dttm")),
        Field("discharge_dttm", "time", required=False),
        Field("age_at_admission", "number", required=False),
        Field("admission_type_category", "category", required=False),
        Field("discharge_category", "category", required=False),
    ),
    "adt": (
        Field("hospitalization_id", "id"),
        Field("location_category", "category"),
        Field("location_type", "category", required=False),
        Field("location_name", "label", required=False),
        Field("in_dttm", "time", ("intime", "location_in_dttm")),
        Field("out_dttm", "time", ("outtime", "location_out_dttm"), required=False),
    ),
    "respiratory_support": (
        Field("hospitalization_id", "id"),
        Field("recorded_dttm", "time", ("record_dttm",)),
        Field("device_category", "category", ("device_name",)),
        Field("mode_category", "category", required=False),
        Field("tracheostomy", "flag", required=False),
        Field("tidal_volume_obs", "number", required=False),
        Field("tidal_volume_set", "number", required=False),
        Field("plateau_pressure_obs", "number", required=False),
        Field("peep_obs", "number", required=False),
        Field("peep_set", "number", required=False),
        Field("fio2_set", "number", required=False),
        Field("pressure_support_set", "number", required=False),
    ),
    "vitals": (
        Field("hospitalization_id", "id"),
        Field("vital_category", "category"),
        Field("recorded_dttm", "time"),
        Field("vital_value", "number"),
    ),
    "labs": (
        Field("hospitalization_id", "id"),
        Field("lab_category", "category"),
        Field("lab_collect_dttm", "time", required=False),
        Field("lab_result_dttm", "time", required=False),
        Field("lab_value_numeric", "number"),
    ),
    "medication_admin_continuous": (
        Field("hospitalization_id", "id"),
        Field("admin_dttm", "time"),
        Field("med_category", "category"),
        Field("med_dose", "number", required=False),
        Field("med_dose_unit", "category", required=False),
        Field("mar_action_category", "category", required=False),
    ),
    "position": (
        Field("hospitalization_id", "id"),
        Field("recorded_dttm", "time"),
        Field("position_category", "category"),
    ),
}


def scan_table(
    spark: SparkSession,
    folder: str,
    name: str,
    fmt: str = "parquet",
    keep: Mapping[str, Sequence[str]] | None = None,
    keys: DataFrame | None = None,
) -> DataFrame:
    """A conformed source table.

    ``keep`` lists wanted category values; ``keys`` is a table of wanted ids and becomes a semi join,
    so no id list passes through the driver.
    """
    path = resolve_table(spark, folder, name, fmt)
    if path is None:
        raise FileNotFoundError(f"no {name} table in {folder}")
    df = conform(read_path(spark, path), SCHEMAS[name])
    for column, values in (keep or {}).items():
        df = df.where(F.col(column).isin(*[v.lower() for v in values]))
    return df.join(keys, list(keys.columns), "left_semi") if keys is not None else df


def load_site(spark: SparkSession, folder: str, fmt: str = "parquet", names: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """Every known source table the folder has, conformed and lazy."""
    out = {}
    for name in names or SCHEMAS:
        if resolve_table(spark, folder, name, fmt):
            out[name] = scan_table(spark, folder, name, fmt)
    return out


class Stages:
    """Stage tables on shared storage, reused only under the same configuration."""

    def __init__(self, spark: SparkSession, root: str, refresh: bool | Sequence[str] = False):
        self.spark, self.root, self.refresh = spark, root.rstrip("/"), refresh

    def _stale(self, name: str) -> bool:
        return self.refresh is True or (not isinstance(self.refresh, bool) and name in self.refresh)

    def get(self, name: str, key: str, build: Callable[[], DataFrame]) -> DataFrame:
        """The stored stage, or a freshly built and stored one."""
        path = f"{self.root}/{name}-{key}"
        jvm = self.spark.sparkContext._jvm
        done = jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
        fs = done.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if self._stale(name) or not fs.exists(done):
            build().write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)


def write_csv(df: DataFrame, path: str, site: str, generated: str, single_file: bool = False) -> None:
    """Report rows with the site first and the time last (S8). ``single_file`` gathers a report known to be small."""
    rest = [c for c in df.columns if c not in ("site", "generated")]
    out = df.select(F.lit(site).alias("site"), *rest, F.lit(generated).alias("generated"))
    out = out.repartition(1) if single_file else out
    out.write.mode("overwrite").option("header", True).csv(path)
