"""Encoders for service and operation names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trendloom.options import encoder_name


def encode_name(name: Column, encoder: str) -> Column:
    """``period`` turns dots into three underscores, ``base64`` pads with underscores, ``noop`` keeps."""
    kind = encoder_name(encoder)
    if kind == "period":
        return F.replace(name, F.lit("."), F.lit("___"))
    if kind == "base64":
        one_line = F.replace(F.base64(F.encode(name, "UTF-8")), F.lit("\r\n"), F.lit(""))
        return F.translate(one_line, "=", "_")
    return name
