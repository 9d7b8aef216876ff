from gaugeworks.functions.columns import (
    blank_to_null,
    differs,
    is_finite,
    is_uuid,
    ntz_instant,
    outside,
    point_part,
    strip,
    to_decimal,
    to_double,
    to_instant,
    to_int,
)

__all__ = [
    "blank_to_null",
    "differs",
    "is_finite",
    "is_uuid",
    "ntz_instant",
    "outside",
    "point_part",
    "strip",
    "to_decimal",
    "to_double",
    "to_instant",
    "to_int",
]
