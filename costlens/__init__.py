"""costlens: Spark jobs that turn benchmark run outputs into cost comparisons.

Every public function takes and returns lazy ``DataFrame`` objects; nothing is
collected to the driver except the small option lists in
``costlens.operators.options``.

Sub-packages:

* ``sources``   – readers for run trees, manifests, price and metadata files.
* ``functions`` – column expressions (finite test, guarded ratios, path parts,
  labels, custom sort order).
* ``operators`` – DataFrame -> DataFrame steps (unpivot, enrich, medians,
  winners, options, price-list parsing).
* ``plans``     – user-level jobs composed of the operators (exports, price
  snapshot, chart tables, views) and the query catalogue.
"""

__all__ = ["constants", "schemas", "session"]
