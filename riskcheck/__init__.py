"""Registered queries over the given tables, each with its SQL twin if it has one."""

from riskcheck import modelling, preparing, profiling, sampling, whole
from riskcheck.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "modelling", "preparing", "profiling", "sampling", "whole"]
