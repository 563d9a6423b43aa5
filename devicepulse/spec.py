"""What a telemetry table looks like: which columns identify a device, a day, a label."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The column of stage tables that they are laid out by. It is never null, whatever the device columns hold.
DEVICE_HASH = "_device"


@dataclass(frozen=True)
class TelemetrySpec:
    """Column roles and thresholds shared by every operator.

    Column and threshold defaults are fixed values of the workload being served.
    """

    id_cols: tuple[str, ...] = ("serial_number", "model")
    date_col: str = "date"
    target_col: str = "failure"
    cycle_id_col: str = "cycle_id"
    cycle_seq_col: str = "cycle_seq"
    cycle_start_col: str = "cycle_start"
    gap_days: int = 1
    num_lags: int = 3
    null_cutoff: float = 0.4
    holdout_fraction: float = 0.1
    metric: str = "f1"
    seed: int = 42

    def __post_init__(self):
        object.__setattr__(self, "id_cols", tuple(self.id_cols))

    @property
    def ids(self) -> list[str]:
        return list(self.id_cols)

    @property
    def day_key(self) -> list[str]:
        """Device and day: the grain of the telemetry table and its sort order."""
        return [*self.id_cols, self.date_col]

    @property
    def cycle_key(self) -> list[str]:
        return [*self.id_cols, self.cycle_seq_col]

    @property
    def cycle_cols(self) -> list[str]:
        return [self.cycle_id_col, self.cycle_seq_col, self.cycle_start_col]

    @property
    def protected(self) -> list[str]:
        """Columns that no profile may drop."""
        return [self.date_col, self.target_col, *self.id_cols]

    @property
    def reserved(self) -> list[str]:
        """Columns that are never features."""
        return [*self.id_cols, self.date_col, self.target_col, *self.cycle_cols]

    def feature_cols(self, df: DataFrame) -> list[str]:
        return [c for c in df.columns if c not in self.reserved]

    def numeric_feature_cols(self, df: DataFrame) -> list[str]:
        numeric = set(numeric_cols(df))
        return [c for c in self.feature_cols(df) if c in numeric]

    def with_(self, **changes) -> TelemetrySpec:
        return replace(self, **changes)

    def hashed(self) -> TelemetrySpec:
        """The same for tables that have `DEVICE_HASH`: it comes before the device columns in every key, so that
        windows and joins of tables laid out by it need no shuffle."""
        return self if DEVICE_HASH in self.id_cols else replace(self, id_cols=(DEVICE_HASH, *self.id_cols))

    def with_device_hash(self, df: DataFrame) -> DataFrame:
        ids = [c for c in self.id_cols if c != DEVICE_HASH]
        return df.withColumn(DEVICE_HASH, F.xxhash64(*ids))


def numeric_cols(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def non_string_cols(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, T.StringType)]
