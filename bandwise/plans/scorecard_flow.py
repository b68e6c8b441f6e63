"""Scorecard chain: profile -> split -> categorical WOE -> numeric tree WOE ->
final WOE -> IV filter -> Cramér's V selection -> manual regrouping -> final WOE.

Each step is a method returning ``self``; fitted tables are DataFrames on the
object. Row-level state stays in Spark; the driver holds only the per-variable
lists (cut points, dropped names).
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql.types import NumericType, StringType

from bandwise.operators.prep import drop_constant
from bandwise.operators.profile import univariate
from bandwise.operators.scorecard import (apply_cuts, apply_level_bins, cramers_v, cramers_v_select,
                                          iv_filter, iv_totals, level_bin_map, structure_bin_map,
                                          woe_binned, woe_categorical)
from bandwise.operators.split import train_test_split
from bandwise.operators.treebin import tree_binning


class Scorecard:
    def __init__(self, base: DataFrame, target: str = "target", key_cols: list[str] | None = None):
        self.base = base
        self.target = target
        self.key_cols = key_cols or []

    def univariate(self):
        self.var_start_list = univariate(self.base, target=self.target)
        return self

    def train_test_split(self, seed: int = 1, test_size: float = 0.2):
        keep = [self.target] + self.key_cols
        self.base, self.dropped_constant = drop_constant(self.base, keep=keep)
        train, self.test = train_test_split(self.base, self.key_cols, seed, test_size)
        # Every later step reads the train rows: keep them (recomputable from lineage on loss).
        self.train = train.persist(StorageLevel.MEMORY_AND_DISK)
        feats = [f for f in self.base.schema.fields if f.name not in keep]
        self.cat_cols = [f.name for f in feats if isinstance(f.dataType, StringType)]
        self.num_cols = [f.name for f in feats if isinstance(f.dataType, NumericType)]
        return self

    def woe_categorical_fit_transform(self, min_percentage_bin: float = 0.06,
                                      small_sample_floor: float = 0.0025):
        self.woe_cat = woe_categorical(self.train, self.cat_cols, self.target,
                                       min_percentage_bin, small_sample_floor)
        self.bin_map = level_bin_map(self.woe_cat)
        self.train_c = apply_level_bins(self.train, self.cat_cols, self.bin_map)
        return self

    def woe_numeric_fit_transform(self, bins: int = 6, special_values=(-1.0,), tree_cut: float = 0.0):
        self.nodes, self.cuts = tree_binning(self.train, self.num_cols, self.target, bins, tree_cut,
                                             list(special_values))
        self.train_binned = apply_cuts(self.train_c, self.cuts).persist(StorageLevel.MEMORY_AND_DISK)
        self.woe_num = woe_binned(self.train_binned, self.num_cols, self.target)
        return self

    def woe_final_transform(self):
        cat = self.woe_cat.select("var", "bin", "is_total", *[c for c in self.woe_cat.columns
                                                              if c not in ("var", "bin", "is_total", "bin_id", "cuts")])
        self.woe_final = self.woe_num.unionByName(cat)
        self.woe_all = iv_totals(self.woe_final)
        return self

    def iv_filter_transform(self, iv_min: float = 0.02):
        self.iv_keep, self.iv_drop = iv_filter(self.woe_all, iv_min)
        cols = [c for c in self.cat_cols + self.num_cols if c in self.iv_keep]
        self.selected = cols
        return self

    def cramers_v(self, cv_max: float = 0.6):
        self.cramers_pairs = cramers_v(self.train_binned, self.selected)
        self.cramers_drop, self.cramers_table = cramers_v_select(self.cramers_pairs, self.woe_all, cv_max)
        self.selected = [c for c in self.selected if c not in self.cramers_drop]
        return self

    def modify_categorical(self, structure: dict[str, list[list[str]]]):
        """Manual regrouping (C18): the listed variables take the given level groups
        (unknown levels -> the group holding 'Others'); the others keep their fitted
        bins. Binning is row-wise (broadcast maps + CASE), so the selection is rebuilt
        from the train rows in one pass - no join of binned and regrouped tables."""
        spark = self.train.sparkSession
        keep = [c for c in self.selected if c not in structure]
        others = [c for c in self.cat_cols if c not in structure]
        x = apply_level_bins(self.train, others, self.bin_map)
        x = apply_level_bins(x, list(structure), structure_bin_map(spark, structure))
        x = apply_cuts(x, {c: v for c, v in self.cuts.items() if c not in structure})
        self.selected = keep + list(structure)
        self.f_selection = x.select(*self.key_cols, self.target, *self.selected)
        return self

    def woe_scaling(self):
        src = getattr(self, "f_selection", None)
        if src is None:
            src = self.train_binned
        self.woe_scaled = woe_binned(src, self.selected, self.target)
        return self

    def release(self):
        """Drop the cached train tables."""
        for name in ("train", "train_binned"):
            df = getattr(self, name, None)
            if df is not None:
                df.unpersist()
        return self

    def run(self, structure: dict | None = None, iv_min: float = 0.02, cv_max: float = 0.6):
        self.univariate().train_test_split().woe_categorical_fit_transform().woe_numeric_fit_transform()
        self.woe_final_transform().iv_filter_transform(iv_min).cramers_v(cv_max)
        if structure:
            self.modify_categorical(structure)
        return self.woe_scaling()

