"""Run date and run id taken from a file path.

A run file lives at ``.../runs/<YYYY-MM-DD>/<run_id>/output/<file>`` and its
manifest at ``.../runs/<YYYY-MM-DD>/<run_id>/manifest.json``. A path that does
not follow the layout gives ``''``. The path is split into folders, which are
then taken by their position.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RUNS_FOLDER = "runs"
DAY = r"^\d{4}-\d{2}-\d{2}$"


def decode_path(path: Column) -> Column:
    """Undo the percent-encoding of file URIs, keeping literal '+' signs."""
    return F.url_decode(F.regexp_replace(path, r"\+", "%2B"))


def path_group(path: Column, pattern: str, group: int) -> Column:
    """``regexp_extract`` with the Java pattern given as a Python string."""
    return F.regexp_extract(path, pattern, group)


def _folder(names: Column, from_end: int) -> Column:
    return F.coalesce(F.try_element_at(names, F.lit(-from_end)), F.lit(""))


def run_date_from_path(path: Column) -> Column:
    """The day folder right below a runs folder, as a string ('' if absent)."""
    names = F.split(path, "/")
    below_runs = lambda name, i: (i > 0) & (i < F.size(names) - 1) & (names[F.greatest(i - 1, F.lit(0))] == RUNS_FOLDER)
    days = F.filter(names, lambda name, i: name.rlike(DAY) & below_runs(name, i))
    return F.when(path.isNotNull(), F.coalesce(F.try_element_at(days, F.lit(1)), F.lit("")))


def run_id_from_path(path: Column, tail: str) -> Column:
    """The folder two levels below ``runs/`` whose remainder is exactly ``tail``.

    ``tail`` is e.g. ``output/md_benchmark.out`` or ``manifest.json``.
    """
    names = F.split(path, "/")
    depth = tail.count("/") + 1
    in_place = path.endswith(f"/{tail}") & (_folder(names, depth + 3) == RUNS_FOLDER) & (_folder(names, depth + 2) != "")
    return F.when(in_place, _folder(names, depth + 1)).when(path.isNotNull(), F.lit(""))
