"""Whole jobs put together from the operators."""

from tarnlake.plans.clean import clean_file
from tarnlake.plans.dimensions import load_dimension
from tarnlake.plans.report import Report, build_report, save_report

__all__ = ["Report", "build_report", "clean_file", "load_dimension", "save_report"]
