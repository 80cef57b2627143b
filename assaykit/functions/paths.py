"""Path and name expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# File suffixes counted as images.
IMAGE_SUFFIXES = [".jpg", ".jpeg", ".png", ".webp", ".bmp"]


def first_component(path: Column) -> Column:
    return F.split_part(path, F.lit("/"), F.lit(1))


def basename(path: Column) -> Column:
    return F.split_part(path, F.lit("/"), F.lit(-1))


def suffix_lower(name: Column) -> Column:
    """Lower-cased extension with its dot; '' without one and for dot-files."""
    return F.lower(F.regexp_extract(name, r"[^/](\.[^./]+)$", 1))


def stem(name: Column) -> Column:
    return F.regexp_replace(name, r"([^/])\.[^./]+$", "$1")


def relative_to(path: Column, root: str) -> Column:
    """Path below `root` with forward slashes; other paths only get the slashes."""
    root = root.replace("\\", "/").rstrip("/") + "/"
    clean = F.translate(path, "\\", "/")
    return F.when(
        clean.startswith(root), F.substring(clean, len(root) + 1, 2_147_483_647)
    ).otherwise(clean)


def item_id(split: Column, class_name: Column, number: Column) -> Column:
    """Six digits at least; longer numbers keep all theirs."""
    return F.format_string("%s_%s_%06d", split, class_name, number)


def item_filename(class_name: Column, number: Column, suffix: Column) -> Column:
    return F.format_string("%s_%06d%s", class_name, number, suffix)


def artifact_model(name: Column) -> Column:
    """Model part of `<model>_<cleaned...>`; the whole stem when no such tag is there."""
    s = stem(name)
    return F.when(_has_tag(s), F.regexp_extract(s, _TAGGED, 1)).otherwise(s)


def artifact_tag(name: Column) -> Column:
    s = stem(name)
    return F.when(_has_tag(s), F.regexp_extract(s, _TAGGED, 2)).otherwise(F.lit("unknown"))


# Fixed value: the first underscore-separated token "cleaned" starts the version tag.
_TAGGED = r"^(?:(.*?)_)?(cleaned(?:_.*)?)$"


def _has_tag(s: Column) -> Column:
    return s.rlike(r"(^|_)cleaned(_|$)")


def tag_from_filename(name: Column, prefix: str = "model_comparison_") -> Column:
    return F.replace(stem(name), F.lit(prefix), F.lit(""))


def run_name(model: Column, tag: Column, at: Column) -> Column:
    return F.concat_ws("_", model, tag, F.date_format(at, "yyyyMMdd_HHmmss"))
