"""Readers of the six input tables, and their materialisation in shared storage."""

from .delimited import read_delimited
from .staging import Stage, stage_for
from .warehouse import read_warehouse

__all__ = ["Stage", "read_delimited", "read_warehouse", "stage_for"]
