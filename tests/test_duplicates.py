import random

import pytest

from assaykit.operators import duplicates, validation

FIELDS = """image_id string, split string, class_name string, width int, height int,
    quality_score double, near_duplicates_score double"""


def settle_by_hand(rows, groups):
    """Groups in order, each overwriting what earlier ones wrote; flags only ever go up."""
    items = {r[0]: r for r in rows}
    state = {}
    for kind, _, members in sorted(groups, key=lambda g: (["exact", "near"].index(g[0]), g[1])):
        known = sorted({m for m in members if m in items})
        if len(known) < 2:
            continue

        def place(m):
            _, split, _, width, height, quality, _ = items[m]
            return (
                0 if split == "train" else 1,
                quality is None,
                -(quality or 0),
                width is None,
                -(width or 0),
                height is None,
                -(height or 0),
                m,
            )

        best = min(known, key=place)
        splits = {items[m][1] for m in known}
        classes = {items[m][2] for m in known}
        for m in known:
            s = state.setdefault(m, {"canon": None, "of": None, "reason": None, "dist": None,
                                     "xs": None, "xc": None, "rev": 0, "ex": 0, "nr": 0})
            s["canon"] = best
            if m == best:
                continue
            s["of"] = best
            score = items[m][6]
            s["dist"] = score if kind == "near" and score is not None else 0.0
            s["xs"] = int(items[m][1] != items[best][1])
            s["xc"] = int(items[m][2] != items[best][2])
            s["ex" if kind == "exact" else "nr"] = 1
            if "train" in splits and items[m][1] == "test":
                s["reason"] = "drop_test_duplicate_train_priority"
            elif len(splits) == 1 and len(classes) == 1:
                s["reason"] = "drop_same_split_same_class_lower_quality"
            elif len(splits) == 1:
                s["rev"] = 1
                s["reason"] = "keep_cross_class_duplicate_same_split_manual_review"
            else:
                s["reason"] = "drop_noncanonical_duplicate"
    return {
        m: (s["canon"], s["of"], s["dist"], s["xs"], s["xc"], s["reason"], s["rev"], s["ex"], s["nr"])
        for m, s in state.items()
    }


@pytest.mark.parametrize("seed", range(4))
def test_overlapping_groups(spark, seed):
    rng = random.Random(seed)
    rows = [
        (
            f"i{n:02d}",
            rng.choice(["train", "test", "val", None] if seed % 2 else ["train", "test"]),
            rng.choice(["a", "b", None]),
            rng.choice([10, 20, None]),
            rng.choice([10, 20, None]),
            rng.choice([0.0, -2.5, -5.0]),
            rng.choice([0.5, None]),
        )
        for n in range(30)
    ]
    groups = []
    for g in range(14):
        kind = rng.choice(["exact", "near"])
        members = [f"i{rng.randrange(34):02d}" for _ in range(rng.randrange(1, 6))]
        groups.append((kind, f"{kind}:{g:02d}", members))
    groups.append(("exact", "exact:99", [r[0] for r in rows[:20]]))  # one large group
    flat = [(gid, kind, m) for kind, gid, members in groups for m in members]
    frame = spark.createDataFrame(rows, FIELDS)
    named = duplicates.union_groups(
        spark.createDataFrame(flat, "group_id string, kind string, member string")
    )
    members = duplicates.group_members(named, frame)
    got = duplicates.last_writer_wins(duplicates.resolve_in_groups(members, rows_per_task=5))
    mine = {
        r["member"]: (
            r["canonical_image_id"], r["duplicate_of"], r["duplicate_distance"],
            r["cross_split_duplicate"], r["cross_class_duplicate"], r["drop_reason"],
            r["manual_review_required"], r["dup_exact"], r["dup_near"],
        )
        for r in got.collect()
    }
    assert mine == settle_by_hand(rows, groups)


# Published outcome of the validation job: ids, group kind and near score of the five groups.
GOLDEN_GROUPS = [
    ("exact", ["test_bedroom_000005", "train_bathroom_000033"]),
    ("exact", ["test_livingroom_000008", "train_bathroom_000012"]),
    ("exact", ["train_bathroom_000003", "train_bedroom_000020"]),
    ("exact", ["train_bedroom_000017", "train_kitchen_000073"]),
    ("near", ["train_bedroom_000024", "train_bedroom_000033"]),
]
GOLDEN_REASONS = {
    "test_bedroom_000005": "drop_test_duplicate_train_priority",
    "test_livingroom_000008": "drop_test_duplicate_train_priority",
    "train_bedroom_000020": "keep_cross_class_duplicate_same_split_manual_review",
    "train_bedroom_000033": "drop_same_split_same_class_lower_quality",
    "train_kitchen_000073": "keep_cross_class_duplicate_same_split_manual_review",
}


def test_published_duplicate_report(spark):
    ids = sorted({i for _, members in GOLDEN_GROUPS for i in members})
    near = set(GOLDEN_GROUPS[4][1])
    exact = set(ids) - near
    index = spark.createDataFrame(
        [(i, "raw/" + i, *i.split("_")[:2], 300, 300) for i in ids] + [("train_kitchen_000001", "raw/x", "train", "kitchen", 300, 300)],
        "image_id string, raw_path string, split string, class_name string, width int, height int",
    )
    issues = index.selectExpr(
        "raw_path",
        f"image_id in {tuple(sorted(exact))} as is_exact_duplicates_issue",
        f"image_id in {tuple(sorted(near))} as is_near_duplicates_issue",
        f"case when image_id in {tuple(sorted(near))} then 0.5D end as near_duplicates_score",
    )
    groups = spark.createDataFrame(
        [(f"g{n}", kind, m) for n, (kind, ms) in enumerate(GOLDEN_GROUPS) for m in ms],
        "group_id string, kind string, member string",
    )
    table = validation.validate(index, issues, groups, stamp="now")
    report = {r["image_id"]: r for r in validation.duplicate_report(table).collect()}
    assert set(report) == set(ids)
    assert {i: r["drop_reason"] for i, r in report.items() if r["drop_reason"]} == GOLDEN_REASONS
    assert report["train_bedroom_000033"]["duplicate_distance"] == 0.5
    assert report["train_bedroom_000020"]["manual_review_required"] == 1
    summary = validation.validation_summary(table).first()
    assert (summary["total_images"], summary["valid_images"]) == (11, 8)
    assert (summary["exact_duplicate_images"], summary["near_duplicate_images"]) == (8, 2)
    by = validation.validation_by_split_class(table).collect()
    assert sum(r["total_images"] for r in by) == 11


def test_empty_table_gives_null_sums(spark):
    from assaykit.schemas import VALIDATION, empty

    row = validation.validation_summary(empty(spark, VALIDATION)).first()
    assert row["total_images"] == 0 and row["valid_images"] is None and row["valid_ratio"] is None
