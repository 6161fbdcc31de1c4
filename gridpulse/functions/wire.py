"""The JSON reading on the wire."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridpulse import schemas


def encode(*fields: Column | str) -> Column:
    """One JSON object of the given fields, as UTF-8 bytes."""
    return F.to_json(F.struct(*fields)).cast("binary")


def decode(value: Column | str) -> Column:
    """A struct of the declared fields from JSON bytes.

    Permissive: an unreadable field is null, and an unreadable payload is a struct
    of nulls. Unknown keys are ignored.
    """
    value = F.col(value) if isinstance(value, str) else value
    return F.from_json(value.cast("string"), schemas.RAW)
