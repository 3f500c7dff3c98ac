"""Run settings: quality thresholds, locations of the layers, expected files."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, fields

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Thresholds:
    max_duration: int = 480
    max_speed: int = 100
    max_tip: int = 100
    year_min: int = 2018
    year_max: int = 2024
    # declared limits of the opt-in checks
    payment_types: tuple[int, ...] = (1, 2, 3, 4, 5, 6)
    min_passengers: int = 0
    max_passengers: int = 9
    min_duration: float = 0.0
    min_fare: float = 0.0
    min_total: float = 0.0
    min_distance: float = 0.0
    max_rejection_pct: float = 80.0

    def as_text(self) -> dict[str, object]:
        """Values ready to be formatted into a predicate text."""
        values = {f.name: getattr(self, f.name) for f in fields(self)}
        values["payment_types"] = ", ".join(str(p) for p in self.payment_types)
        return values


@dataclass(frozen=True)
class ExpectedFile:
    service_type: str
    file_name: str
    year: str | None = None
    month: str | None = None


@dataclass(frozen=True)
class Settings:
    """`root` is a folder every executor can reach (object store, HDFS, shared mount)."""

    root: str
    raw_dir: str | None = None
    database: str = "default"
    thresholds: Thresholds = field(default_factory=Thresholds)
    expected_files: tuple[ExpectedFile, ...] = ()
    opt_in_rules: tuple[str, ...] = ()
    deep_validate: bool = False
    cluster_bronze: bool = False
    incremental: bool = False
    contracts: str | None = None  # contract documents that go before the built-in contracts
    max_records_per_file: int = 2_000_000

    @property
    def raw(self) -> str:
        return self.raw_dir or f"{self.root}/raw"

    def layer(self, *parts: str) -> str:
        return "/".join((self.root.rstrip("/"), *parts))


# Setting names accepted in the `quality_rules` section of a settings file.
_THRESHOLD_NAMES = {
    "max_trip_duration_minutes": "max_duration",
    "max_speed_mph": "max_speed",
    "max_tip_percentage": "max_tip",
    "reference_year_min": "year_min",
    "reference_year_max": "year_max",
    "valid_payment_types": "payment_types",
    "min_passengers": "min_passengers",
    "max_passengers": "max_passengers",
    "min_trip_duration_minutes": "min_duration",
    "min_fare_amount": "min_fare",
    "min_total_amount": "min_total",
    "min_trip_distance": "min_distance",
    "max_rejection_pct": "max_rejection_pct",
}


def settings_from_dict(raw: dict) -> Settings:
    rules = raw.get("quality_rules", {})
    chosen = {
        ours: tuple(rules[theirs]) if ours == "payment_types" else rules[theirs]
        for theirs, ours in _THRESHOLD_NAMES.items()
        if theirs in rules
    }
    expected = [
        ExpectedFile(service, f["name"], str(f["year"]), str(f["month"]))
        for service, source in raw.get("data_sources", {}).items()
        for f in source.get("files", [])
    ]
    expected += [
        ExpectedFile("bad_parquet", name)
        for name in raw.get("bad_parquet_sources", {}).get("files", [])
    ]
    top = {k: raw[k] for k in ("raw_dir", "database", "deep_validate", "cluster_bronze", "incremental", "contracts") if k in raw}
    return Settings(
        root=raw["root"],
        thresholds=Thresholds(**chosen),
        expected_files=tuple(expected),
        opt_in_rules=tuple(raw.get("opt_in_rules", ())),
        **top,
    )


def load_settings(spark: SparkSession, path: str) -> Settings:
    """Read a JSON (or, where PyYAML is installed, YAML) settings file from any Spark path."""
    text = spark.read.text(path, wholetext=True).first()[0]
    if path.endswith((".yaml", ".yml")):
        try:
            import yaml
        except ImportError as missing:
            raise RuntimeError("YAML settings need PyYAML; use JSON instead") from missing
        return settings_from_dict(yaml.safe_load(text))
    return settings_from_dict(json.loads(text))
