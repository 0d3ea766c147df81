import datetime as dt

import pytest
from conftest import tuples

from callspark.operators import ivr
from callspark.plans import relational as plans
from callspark.sources import named

SCHEMA = (
    "accountId string, conversationId string, recognizerResult_text string, recognizerResult_intent_value string, "
    "recognizerResult_intent_score double, timestamp timestamp_ntz, event_Name string, event_Type string, "
    "brd_ActivityId string, brd_Text string"
)


def at(minute):
    return dt.datetime(2024, 1, 1, 10, minute)


def answer(conv, minute, text, intent, score=0.5):
    return ("acc", conv, text, intent, score, at(minute), None, None, None, None)


def question(conv, minute, text):
    return (None, conv, None, None, None, at(minute), None, None, "id", text)


@pytest.fixture(scope="module")
def events(spark):
    return spark.createDataFrame([
        # a question, a misunderstanding, a question, the first answer, a later answer
        question("ok", 1, "q1"), answer("ok", 2, "mumble", "didnt_understand"), question("ok", 3, "q2"),
        answer("ok", 4, "bill", "billing", 0.9), answer("ok", 5, "power", "outage", 0.8),
        # only misunderstandings
        question("none", 1, "q"), answer("none", 2, "mumble", "didnt_understand"),
        # one space is not an answer, an empty text is; a null intent is not
        question("space", 1, "q"), answer("space", 2, " ", "billing"), answer("space", 3, "x", None),
        answer("space", 4, "", "billing"),
        # the first event is the answer, so nothing is before it
        answer("first", 1, "bill", "billing"), question("first", 2, "q"),
        # the last event before the answer has no question
        question("null", 1, "q1"), question("null", 2, None), answer("null", 3, "bill", "billing"),
        # equal times: the smaller answer wins, and nothing is strictly before
        answer("tie", 2, "b", "two"), answer("tie", 2, "a", "one"), question("tie", 1, "q"), question("tie", 2, "late"),
    ], SCHEMA)


def test_first_response(events):
    got = {r.conversationId: r.recognizerResult_text for r in ivr.first_response(events).collect()}
    assert got == {"ok": "bill", "space": "", "first": "bill", "null": "bill", "tie": "a"}


def test_events_before_response(events):
    got = tuples(ivr.events_before_response(events), "conversationId", "timeStamp", "USER_RESPONSE", "IVR_QUESTION")
    assert got == sorted([
        ("ok", at(1), "bill", "q1"), ("ok", at(2), "bill", None), ("ok", at(3), "bill", "q2"),
        ("space", at(1), "", "q"), ("space", at(2), "", None), ("space", at(3), "", None),
        ("null", at(1), "bill", "q1"), ("null", at(2), "bill", None), ("tie", at(1), "a", "q"),
    ], key=lambda r: tuple((x is None, str(x)) for x in r))


def test_hot_conversation_is_spread(events):
    assert tuples(ivr.events_before_response(events, rows_per_task=1)) == tuples(ivr.events_before_response(events))


def test_intent_per_call(events):
    before = ivr.events_before_response(events)
    last = {r.callSid: r.IVR_Question for r in ivr.intent_per_call(before).collect()}
    assert last == {"ok": "q2", "space": None, "null": None, "tie": "q"}
    asked = {r.callSid: r.IVR_Question for r in ivr.intent_per_call(before, ignore_null_question=True).collect()}
    assert asked == {"ok": "q2", "space": "q", "null": "q1", "tie": "q"}


def test_partition_count_does_not_matter(events):
    one = ivr.intent_per_call(ivr.events_before_response(events.coalesce(1)))
    many = ivr.intent_per_call(ivr.events_before_response(events.repartition(7)))
    assert tuples(one) == tuples(many)


def test_named_statements_equal_operators(spark, events):
    before = ivr.events_before_response(events)
    assert tuples(named.run_named(spark, "Minimum", {"dfUnion": events})) == tuples(before)
    aggregated = named.run_named(spark, "Aggregate", {"Intent": before})
    assert tuples(aggregated) == tuples(ivr.intent_per_call(before))


def test_ivr_intent_filters_channel_and_window(spark):
    nlp = spark.createDataFrame(
        [("a", "c", at(5), "TwilioVoice", "bill", "billing", 0.9), ("a", "d", at(5), "Chat", "bill", "billing", 0.9)],
        "accountId string, conversationId string, timeStamp timestamp_ntz, channelId string, "
        "eventMessage_recognizerResult_text string, eventMessage_topIntent string, eventMessage_topIntentScore double",
    )
    transfer = spark.createDataFrame(
        [], "conversationId string, timestamp timestamp_ntz, channelId string, event_Name string, event_Type string"
    )
    audio = spark.createDataFrame(
        [("c", at(1), "TwilioVoice", "1", "q"), ("c", dt.datetime(2023, 12, 31, 23, 59), "TwilioVoice", "2", "old"),
         ("d", at(1), "TwilioVoice", "3", "q")],
        "conversationId string, timestamp timestamp_ntz, channelId string, brd_ActivityId string, brd_Text string",
    )
    got = plans.ivr_intent(nlp, transfer, audio, "2024-01-01", "2024-01-01")
    assert tuples(got) == [("c", "bill", "billing", 0.9, "q")]
