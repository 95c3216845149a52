"""Column-name normalisation (driver-side rename, no data is touched)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

_RUN = re.compile("[A-Za-z0-9]+")


def clean_name(name: object) -> str:
    """The runs of ASCII letters and digits in a name, in lower case, joined by ``_``."""
    return "_".join(_RUN.findall(str(name))).lower()


def clean_columns(df: DataFrame) -> DataFrame:
    """Rename every column by :func:`clean_name`; a collision is an error."""
    names = [clean_name(c) for c in df.columns]
    seen: dict[str, str] = {}
    for raw, new in zip(df.columns, names):
        if new in seen:
            raise ValueError(f"columns {seen[new]!r} and {raw!r} both clean to {new!r}")
        seen[new] = raw
    return df.toDF(*names)


def qcol(name: str):
    """A column by its exact name, whatever characters it holds (dots, spaces, backticks)."""
    from pyspark.sql import functions as F
    return F.col("`" + name.replace("`", "``") + "`")
