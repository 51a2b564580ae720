"""In-row ranking of scored labels."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from hubcat import spec


def ranked_labels(labels: Column, share: float = spec.LABEL_SCORE_SHARE,
                  most: int = spec.MAX_LABELS, multi: bool = True) -> Column:
    """Order ``array<struct(label, score, pos)>`` by score, first seen first on ties.

    With ``multi`` only labels within ``share`` of the best score stay, at most ``most``.
    """
    ordered = F.transform(
        F.array_sort(F.transform(labels, lambda x: F.struct(
            (-x["score"]).alias("down"), x["pos"].alias("pos"), x["label"].alias("label"),
            x["score"].alias("score")))),
        lambda x: F.struct(x["label"].alias("label"), x["score"].alias("score")),
    )
    if not multi:
        return ordered
    top = F.array_max(F.transform(labels, lambda x: x["score"]))
    return F.slice(F.filter(ordered, lambda x: x["score"] >= top * F.lit(share)), 1, most)


def label_names(ranked: Column) -> Column:
    return F.coalesce(F.transform(ranked, lambda x: x["label"]), F.array().cast("array<string>"))


def label_scores(ranked: Column) -> Column:
    return F.coalesce(
        F.map_from_arrays(F.transform(ranked, lambda x: x["label"]),
                          F.transform(ranked, lambda x: x["score"])),
        F.create_map().cast("map<string,double>"),
    )
