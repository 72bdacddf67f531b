"""Coordinate expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def in_bounds(latitude: Column, longitude: Column) -> Column:
    return latitude.between(-90.0, 90.0) & longitude.between(-180.0, 180.0)


def rounded_cell(coordinate: Column) -> Column:
    return F.round(coordinate, 1)


def floored_cell(coordinate: Column) -> Column:
    return F.floor(coordinate * 10) / 10
