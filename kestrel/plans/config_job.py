"""Config-driven extract -> transform -> load job (PIP-01, SRC-01, SNK-01).

An INI section names the input, its format, the output, its format and
mode, the partition columns and an optional partition count. The steps
between extract and load are plain ``DataFrame -> DataFrame`` functions,
chained with ``DataFrame.transform``; the whole job is one lazy plan and
one write action.
"""

from __future__ import annotations

import configparser
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from kestrel.sinks.writers import SinkConfig, write
from kestrel.sources.readers import scan

Step = Callable[[DataFrame], DataFrame]

# The seven keys of the job section (fixed names, as in the reference's config files).
CONFIG_KEYS = ("input_file_path", "source_file_type", "write_format", "write_mode",
               "output_file_path", "partition_col", "repartition")


@dataclass
class JobConfig:
    input_file_path: str
    source_file_type: str
    write_format: str = "parquet"
    write_mode: str = "overwrite"
    output_file_path: str = ""
    partition_col: list[str] = field(default_factory=list)
    repartition: int | None = None

    @classmethod
    def from_ini(cls, text: str, section: str = "SectionETL") -> "JobConfig":
        """Parse an INI section. Values are stripped of blanks and of a
        trailing comma (Q26); an empty partition list means no partitioning."""
        cp = configparser.ConfigParser()
        cp.read_string(text)
        sec = cp[section]

        def val(k: str) -> str:
            return sec.get(k, "").strip().rstrip(",").strip()

        parts = [c.strip() for c in val("partition_col").split(",") if c.strip()]
        rep = val("repartition")
        return cls(val("input_file_path"), val("source_file_type"), val("write_format") or "parquet",
                   val("write_mode") or "overwrite", val("output_file_path"), parts, int(rep) if rep else None)


def run_job(spark: SparkSession, conf: JobConfig, steps: Sequence[Step],
            schema: StructType | str | None = None) -> str:
    """Extract, apply ``steps`` in order, load. Returns the output path."""
    df = scan(spark, conf.source_file_type, conf.input_file_path, schema)
    for step in steps:
        df = df.transform(step)
    return write(df, SinkConfig(conf.output_file_path, conf.write_format, conf.write_mode,
                                conf.partition_col, conf.repartition))
