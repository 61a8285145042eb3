"""Named queries over the driver tables, one module per operator family."""

import importlib

from tabeval.plans.registry import ORACLES, QUERIES

FAMILIES = ["a_sources", "b_catalog", "c_prompts", "d_workload", "e_relational", "e_sixnf", "f_compare", "g_analytics", "h_metrics", "i_benchmark", "j_splits", "k_preprocess", "l_models"]

for family in FAMILIES:
    importlib.import_module(f"tabeval.plans.{family}")

__all__ = ["ORACLES", "QUERIES"]
