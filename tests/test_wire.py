"""Lines, messages and their records."""

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ratewatch.operators import framing, ticks
from ratewatch.schemas import WIRE_FIELDS
from ratewatch.sources import lines

GOOD = "EUR/USD,1530000000000,1.16,512,1.16,514,1.17,1.15,1.165"
QUICK = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))


def text(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def values(rows):
    return [row["value"] for row in rows.collect()]


def test_a_line_needs_nine_fields_and_more_are_ignored(spark):
    given_lines = text(spark, GOOD, GOOD + ",x,y", "EUR/USD,1,2,3,4,5,6,7", "", ",,,,,,,,")
    good = framing.parse_lines(given_lines).collect()
    assert [row["open"] for row in good] == ["1.165", "1.165", ""]
    bad = framing.quarantine_lines(given_lines).collect()
    assert [(row["value"], row["n_fields"]) for row in bad] == [("EUR/USD,1,2,3,4,5,6,7", 8), ("", 1)]


def test_a_response_becomes_one_message_of_its_complete_lines(spark):
    response = f"\n {GOOD}\nshort,line\n\n{GOOD.replace('EUR', 'GBP')}\r\n\n"
    (message,) = values(framing.frame_responses(text(spark, response)))
    records = [json.loads(line) for line in message.split("\n")]
    assert [r["fx_marker"] for r in records] == ["EUR/USD", "GBP/USD"]
    assert list(records[0]) == list(WIRE_FIELDS) and records[0]["open"] == "1.165"


def test_responses_without_complete_lines_give_no_message(spark):
    assert values(framing.frame_responses(text(spark, "", "\n \n", "a,b\nc"))) == []


def test_quotes_and_backslashes_survive(spark):
    odd = GOOD.replace("EUR/USD", 'E"\\U\té')
    message = framing.frame_responses(text(spark, odd))
    assert ticks.ticks_of(message).first()["fx_marker"] == 'E"\\U\té'


def test_quote_files_are_read_by_line_and_by_response(spark, tmp_path):
    (tmp_path / "poll.csv").write_text(f"{GOOD}\n{GOOD}\n")
    assert lines.quote_lines(spark, str(tmp_path)).count() == 2
    assert lines.quote_responses(spark, str(tmp_path)).count() == 1


def test_frames_are_bounded_and_ordered(spark):
    rows = spark.range(0, 1005).select("id", F.concat(F.lit("r"), "id").alias("value"))
    frames = framing.frame_records(rows.repartition(7), "id", 100).orderBy("offset").collect()
    assert len(frames) == 11
    assert frames[3]["value"].split("\n") == [f"r{i}" for i in range(300, 400)]
    assert len(frames[10]["value"].split("\n")) == 5


@QUICK
@given(records=st.lists(st.text(st.characters(blacklist_characters="\n", blacklist_categories=["Cs", "Cc"]), min_size=1), min_size=1, max_size=30), size=st.integers(1, 7))
def test_unframe_undoes_frame(spark, records, size):
    rows = spark.createDataFrame(list(enumerate(records)), "id bigint, value string")
    back = framing.unframe(framing.frame_records(rows, "id", size)).orderBy("offset", "pos")
    assert values(back) == records


@QUICK
@given(st.lists(st.text("a,1 ", max_size=24), min_size=1, max_size=20))
def test_every_line_is_parsed_or_quarantined(spark, given_lines):
    rows = text(spark, *given_lines)
    assert framing.parse_lines(rows).count() == sum(len(v.split(",")) >= 9 for v in given_lines)
    assert framing.quarantine_lines(rows).count() == sum(len(v.split(",")) < 9 for v in given_lines)
