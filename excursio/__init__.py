"""Excursio: marketplace analytics expressed as Spark DataFrames."""

from excursio.warehouse import Warehouse

__all__ = ["Warehouse"]
