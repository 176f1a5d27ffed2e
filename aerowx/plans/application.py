"""The whole application: CSV exports to a chunked learning table, and the
chunks to a trained and scored forest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

from aerowx.plans.learn import LearnResult, learn
from aerowx.plans.preprocess import ml_table
from aerowx.sources.chunks import N_CHUNKS, read_chunks, write_chunks
from aerowx.sources.csv import read_flights, read_stations, read_weather


def preprocess_csv(spark: SparkSession, flights: str, weather: str, stations: str, out: str, *,
                   hours: int = 12, method: str = "list", chunks: int = N_CHUNKS, seed: int = 42, **csv_options) -> str:
    """Read the three exports, build the learning table and write it as
    chunks to ``out``; returns ``out``."""
    table = ml_table(read_flights(spark, flights, **csv_options), read_weather(spark, weather, **csv_options),
                     read_stations(spark, stations, **csv_options), method=method, hours=hours)
    write_chunks(table, out, chunks, seed)
    return out


def learn_from_chunks(spark: SparkSession, path: str, chunks: Sequence[int] | None = None, **options) -> LearnResult:
    """Train and score on the written chunks (all, or the listed ones);
    ``options`` are those of ``learn``."""
    return learn(read_chunks(spark, path, None if chunks is None else list(chunks)), **options)
