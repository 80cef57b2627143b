"""What the plans must not do: move texts, or join what is not asked for."""

import io
from contextlib import redirect_stdout
from pathlib import Path

import pytest

from assaykit.plans import bindings, catalog

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).is_dir(), reason="no test tables")


def plan(frame):
    out = io.StringIO()
    with redirect_stdout(out):
        frame.explain("formatted")
    return out.getvalue()


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("key", ["class_summary", "null_summary", "integrity_flags"])
def test_no_text_is_shuffled(spark, no_broadcast, key):
    for part in plan(catalog.queries()[key](spark, SF)).split("\n\n"):
        if "Exchange" in part.split("\n")[0] or "Sort" in part.split("\n")[0]:
            assert "text#" not in part


@pytest.mark.parametrize("key", ["split_summary", "format_summary", "make_ids"])
def test_no_join_without_label_columns(spark, no_broadcast, key):
    assert "Join" not in plan(catalog.queries()[key](spark, SF))


def test_labels_are_joined_where_asked_for(spark, no_broadcast):
    assert "Join" in plan(bindings.image_index(spark, SF).select("image_mode"))
