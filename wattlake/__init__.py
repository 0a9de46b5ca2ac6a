"""wattlake: a Spark-native medallion pipeline for campus energy data.

Bronze CSV drops -> silver day-partitioned Parquet -> a gold galaxy schema of
hash-keyed dimensions and date-partitioned facts -> marts. Every step is a
DataFrame plan keyed by ``date`` so one job serves one day or many years.
"""

__all__ = ["session"]
