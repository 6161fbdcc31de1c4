"""Expected-profile features of a house: what a reading should look like at an hour.

Every function takes columns or numbers, so the parameters of a house may be
constants or columns of a joined table.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values --------------------------------------------------------------
SUNRISE_H, SUNSET_H = 7.0, 19.0
PV_EFFICIENCY = 0.80
CHARGER_KW = 7.4
BASE_KW = 0.25
LOAD_PEAKS = (  # (height kW, centre h, spread h)
    (1.0, 7.5, 1.0),
    (0.4, 13.0, 1.5),
    (1.6, 19.5, 1.5),
)
KW_DECIMALS, VOLT_DECIMALS = 3, 1

_SECONDS_PER_DAY = 86_400
# 2**27 + 1 splits a double into two halves of at most 26 bits.
_SPLIT = 134_217_729.0


def _col(x: Column | str | float) -> Column:
    return F.lit(float(x)) if isinstance(x, (int, float)) else F.col(x) if isinstance(x, str) else x


def hour_fraction(ts: Column | str) -> Column:
    """Hour of the UTC day, 0 to 24, to the second."""
    return F.pmod(F.unix_seconds(_col(ts)), F.lit(_SECONDS_PER_DAY)) / F.lit(3600.0)


def expected_pv(h: Column | str, size_kw: Column | str | float) -> Column:
    """Half a sine between sunrise and sunset, scaled to the panels; 0 at night."""
    h, size_kw = _col(h), _col(size_kw)
    daylight = (h - F.lit(SUNRISE_H)) / F.lit(SUNSET_H - SUNRISE_H)
    output = size_kw * F.greatest(F.lit(0.0), F.sin(F.pi() * daylight)) * F.lit(PV_EFFICIENCY)
    return F.when(h.between(SUNRISE_H, SUNSET_H), output).otherwise(F.lit(0.0))


def ev_session(h: Column | str, start_h: Column | str | float, duration_h: Column | str | float) -> Column:
    """Charger power during [start, start + duration), else 0."""
    since_start = _col(h) - _col(start_h)
    charging = (since_start >= 0) & (since_start < _col(duration_h))
    return F.when(charging, F.lit(CHARGER_KW)).otherwise(F.lit(0.0))


def base_load(h: Column | str, scale: Column | str | float = 1.0) -> Column:
    """Household load without PV and EV: a floor plus one bell per peak of the day."""
    h = _col(h)
    load = F.lit(BASE_KW)
    for height, centre, spread in LOAD_PEAKS:
        z = (h - F.lit(centre)) / F.lit(spread)
        load = load + F.lit(height) * F.exp(F.lit(-0.5) * z * z)
    return load * _col(scale)


def net_power(load: Column | str, ev: Column | str, pv: Column | str) -> Column:
    """Power drawn from the grid."""
    return _col(load) + _col(ev) - _col(pv)


def house_load(power: Column | str, ev: Column | str, pv: Column | str) -> Column:
    """Load of the house behind a grid reading: the inverse of ``net_power``."""
    return _col(power) - _col(ev) + _col(pv)


def measured(x: Column | str, decimals: int) -> Column:
    """Round a reading to the meter's resolution, by the exact value of the double.

    Ties go to the even neighbour, and a double that only prints like a tie is not
    one (0.15 lies below 0.15). ``round`` and ``bround`` work on the printed digits
    and so differ. ``scaled + rest`` is the product x * 10**decimals without
    rounding error, and ``rest`` decides where ``scaled`` falls halfway.
    """
    x, unit = _col(x), F.lit(float(10**decimals))
    scaled = x * unit
    high = x * F.lit(_SPLIT) - (x * F.lit(_SPLIT) - x)
    rest = (high * unit - scaled) + (x - high) * unit
    below = F.rint(scaled - F.lit(0.5))
    nearest = (
        F.when((scaled - below != F.lit(0.5)) | (rest == 0.0), F.rint(scaled))
        .when(rest > 0.0, below + F.lit(1.0))
        .otherwise(below)
    )
    return nearest / unit
