"""Spend stages and value lines on small literal frames."""

from datetime import date, datetime
from decimal import Decimal

import pytest

from helpers import count_nodes, planned
from martloom.context import RunContext
from martloom.plans import columns as C
from martloom.plans import spend
from martloom.session import scratch_path

RUN = RunContext(datetime(2024, 1, 2), 7)
RULES = spend.SpendRules("2020-01-01T00:00:00.000Z", "2020-02-01T00:00:00.000Z", ("C9",), ("Attended", "No Show"))
IDENTITY = spend.SpendIdentity("COMP", "SRC", "PCOMP", "PSRC")


def landed(spark, columns, *data):
    ddl = ", ".join(f"{c} string" for c in columns)
    return spark.createDataFrame([tuple(d.get(c) for c in columns) for d in data], ddl)


def meeting(number, country="C1", updated="2020-01-15T00:00:00.000Z", final="Yes", **more):
    return {
        "Id": f"M{number}",
        "Event_Id_MERC__c": f"E{number}",
        "Event_Country_MERC__c": country,
        "Date_of_Event_MERC__c": "2020-01-10T08:00:00.000Z",
        "Owner_Master_Id_MERC__c": "123456789",
        "Participant_ToV_Updated_Date_MERC__c": updated,
        "Participant_ToV_Final_MERC__c": final,
        **more,
    }


def participant(number, meeting_number=1, **more):
    return {
        "Id": f"P{number}",
        "Meeting_MERC__c": f"M{meeting_number}",
        "Account_MERC__c": f"A{number}",
        "Participant_Typ_MERC__c": "HCP",
        "Status_MERC__c": "Attended",
        "ToV_Currency_MERC__c": "EUR",
        **more,
    }


@pytest.fixture
def meetings(spark):
    return landed(
        spark,
        C.LANDED_MEETING,
        meeting(1),
        meeting(1),
        meeting(2, country="C9"),
        meeting(3, country=""),
        meeting(4, country=None),
        meeting(5, updated="2020-01-01T00:00:00.000Z"),
        meeting(6, updated="2020-02-01T00:00:00.000Z"),
        meeting(7, final="No"),
    )


def test_event_stage(meetings, rows):
    staged = spend.event_stage(meetings, RULES, RUN)
    # a blank country is not excluded here, an excluded or missing one is
    assert rows(staged, "event_id_merc__c", "date_of_event_merc__c") == [(e, date(2020, 1, 10)) for e in ("E1", "E3", "E6")]


def test_attendee_stage(spark, meetings, rows):
    people = landed(
        spark,
        C.LANDED_PARTICIPANT,
        participant(1, 1, Total_Hotel_ToV_MERC__c="10.005", CoPay_AODS_Hotel_MERC__c="0"),
        participant(2, 2),
        participant(3, 3),
        participant(4, 1, Status_MERC__c="Cancelled"),
        participant(5, 1, Participant_Typ_MERC__c="Staff"),
        participant(6, 99),
        participant(7, 6, Total_Hotel_ToV_MERC__c="many"),
    )
    accounts = landed(spark, C.LANDED_ACCOUNT, {"Id": "A1", "Name": "Ann"})
    staged = spend.attendee_stage(people, meetings, accounts, RULES, RUN)
    # an excluded country is no obstacle here, a blank one is
    assert rows(staged, "id", "event_id_merc__c", "name_glbl__c", "total_hotel_tov_merc__c", "copay_hotel_merc__c") == [
        ("P1", "E1", "Ann", Decimal("10.01"), Decimal("0.00")),
        ("P2", "E2", None, None, None),
        ("P7", "E6", None, None, None),
    ]


def test_day_value_stage(spark, meetings, rows):
    people = landed(spark, C.LANDED_PARTICIPANT, participant(1, 1), participant(1, 1), participant(2, 2), participant(3, 3))
    days = landed(
        spark,
        C.LANDED_DAY_VALUE,
        *[
            {"Id": f"D{n}", "Meeting_Participant_MERC__c": f"P{n}", "Meeting_Day_Date_MERC__c": "2020-01-11", "CurrencyIsoCode": "", "Est_Indv_Transfer_MERC__c": "123456789.10", "Est_Hotel_ToV_MERC__c": ""}
            for n in (1, 2, 3, 4)
        ],
    )
    staged = spend.day_value_stage(days, people, meetings, RULES, RUN)
    # repeated participants do not repeat a day value; amounts of nine digits survive; blanks become null
    assert rows(staged, "id", "currencyisocode", "est_hotel_tov_merc__c", "est_indv_transfer_merc__c", "meeting_day_date_merc__c") == [
        ("D1", None, None, Decimal("123456789.10"), date(2020, 1, 11)),
        ("D3", None, None, Decimal("123456789.10"), date(2020, 1, 11)),
    ]


def joined_rows(spark, *data):
    amounts = [*C.ATTENDEE_AMOUNTS.values(), *C.DAY_AMOUNTS.values()]
    columns = [
        *spend.EVENT_COLUMNS, "id1", "customer_id_glbl__c", "name_glbl__c", "record_type_name__c", "currencyisocode",
        "id", "meeting_day_date_merc__c", "currencyisocode_tov", *amounts,
    ]
    kinds = {**{a: "decimal(16,2)" for a in amounts}, "date_of_event_merc__c": "date", "meeting_day_date_merc__c": "date"}
    base = {"event_id_merc__c": "E", "date_of_event_merc__c": date(2020, 1, 10), "owner_master_id_merc__c": "7", "id1": "P", "currencyisocode": "EUR", "currencyisocode_tov": "USD"}
    return spark.createDataFrame(
        [tuple({**base, **d}.get(c) for c in columns) for d in data], ", ".join(f"{c} {kinds.get(c, 'string')}" for c in columns)
    )


FIVE = Decimal("5.00")


def test_all_eleven_lines(spark, rows):
    amounts = {c: Decimal(i) for i, c in enumerate([*C.ATTENDEE_AMOUNTS.values(), *C.DAY_AMOUNTS.values()])}
    df = joined_rows(spark, {"id": "D", "record_type_name__c": "Other", "meeting_day_date_merc__c": date(2020, 1, 11), **amounts})
    lines = spend.value_lines(df)
    assert {r["value_id"] for r in lines.collect()} == {
        "P_COPAY_HTL", "P_COPAY_GRND_TRNSPRT", "P_COPAY_FOOD_BVRG", "P_COPAY_RGSTRN_FEE", "P_COPAY_RAIL_FLGHT_TRNSPRT",
        "P_COPAY_INDV_GRND_TRNSPRT", "D_HTL", "D_GRND_TRNSPRT", "D_RGSTRN_FEE", "D_FOOD_BVRG", "D_INDV_GRND_TRNSPRT",
    }
    hotel = {r["value_id"]: r for r in lines.collect()}["D_HTL"]
    assert (hotel["currencyisocode"], hotel["value_amount"], hotel["valuepaiddt"]) == ("USD", amounts["est_hotel_tov_merc__c"], "11012020000000")
    sponsored = spend.value_lines(joined_rows(spark, {"id": "D", "record_type_name__c": "Merc_Individual_SPONSORSHIP", **amounts}))
    hotel = {r["value_id"]: r for r in sponsored.collect()}["P_HTL"]
    assert (hotel["currencyisocode"], hotel["value_amount"], hotel["valuepaiddt"]) == ("EUR", amounts["total_hotel_tov_merc__c"], "10012020000000")


def test_zero_is_a_line_and_missing_is_not(spark, rows):
    df = joined_rows(spark, {"id": "D", "copay_hotel_merc__c": Decimal("0.00"), "copay_flight_rail_merc__c": None})
    assert rows(spend.value_lines(df), "value_id", "value_amount") == [("P_COPAY_HTL", Decimal("0.00"))]


def test_copay_repeats_per_day_unless_sponsored(spark):
    days = [{"id": f"D{n}", "meeting_day_date_merc__c": date(2020, 1, n), "copay_hotel_merc__c": FIVE} for n in (1, 2)]
    assert spend.value_lines(joined_rows(spark, *days)).count() == 2
    sponsored = [{**d, "record_type_name__c": "MERC_INDIVIDUAL_SPONSORSHIP"} for d in days]
    assert spend.value_lines(joined_rows(spark, *sponsored)).count() == 1


def test_export_row(spark):
    df = joined_rows(spark, {"id": "D", "copay_hotel_merc__c": FIVE, "owner_master_id_merc__c": "123456789"})
    out = spend.spend_export(df, IDENTITY)
    assert out.columns == C.SPEND_EXPORT and len(out.columns) == 27
    row = out.head()
    assert (row["CompanyCd"], row["SrcSysCd"], row["EventParentCompanyCD"], row["EventParentSrcSysCd"]) == ("COMP", "SRC", "PCOMP", "PSRC")
    assert (row["EventCreatedById"], row["EventStartDt"], row["ValueAmount"]) == ("12345678", "10012020000000", FIVE)
    assert row["EventId"] == row["EventValueCustomerId"] == "P"


def test_lines_that_differ_in_record_type_only_are_exported_once(spark):
    same = [{"id": "D", "copay_hotel_merc__c": FIVE, "record_type_name__c": kind} for kind in ("A", "B")]
    df = joined_rows(spark, *same)
    assert spend.value_lines(df).count() == 2
    assert spend.spend_export(df, IDENTITY).count() == 1


def test_value_lines_read_the_input_once(spark):
    stored = scratch_path(spark, "test-spend")
    joined_rows(spark, {"id": "D", "copay_hotel_merc__c": FIVE}).write.parquet(stored)
    plan = planned(spend.spend_export(spark.read.parquet(stored), IDENTITY))
    assert count_nodes(plan, "Generate") == 1
    assert sum("FileScan" in line for line in plan.splitlines()) == 1
    assert sum("Exchange" in line for line in plan.splitlines()) == 1


def test_window_reaches_the_scan_in_text_mode(spark, settings):
    settings(spark__sql__maxMetadataStringLength="4000")
    stored = scratch_path(spark, "test-meetings")
    landed(spark, C.LANDED_MEETING, meeting(1)).write.parquet(stored)
    rules = spend.SpendRules(RULES.after, RULES.until, RULES.excluded_countries, RULES.statuses, window_mode="text")
    scan = next(line for line in planned(spend.event_stage(spark.read.parquet(stored), rules, RUN)).splitlines() if "FileScan" in line)
    assert "GreaterThan(Participant_ToV_Updated_Date_MERC__c" in scan and "EqualTo(Participant_ToV_Final_MERC__c,Yes)" in scan


def test_rows_that_become_equal_are_staged_once(spark, rows):
    """A participant of two meetings of one event, accounts of one name, and missing ids and events, each twice."""
    several = landed(spark, C.LANDED_MEETING, *[meeting(n, **{"Event_Id_MERC__c": e}) for n, e in ((1, "E"), (2, "E"), (3, None), (3, None))])
    people = landed(
        spark,
        C.LANDED_PARTICIPANT,
        *[participant(1, m, Account_MERC__c=f"A{m}", CoPay_AODS_Hotel_MERC__c="5") for m in (1, 2, 3)],
        *[participant(2, m, Id=None, Account_MERC__c="A1", CoPay_AODS_Hotel_MERC__c="6") for m in (1, 1, 2, 3)],
        *[participant(3, 1, Id="", Account_MERC__c="A1", CoPay_AODS_Hotel_MERC__c="7") for _ in range(2)],
    )
    accounts = landed(spark, C.LANDED_ACCOUNT, *[{"Id": f"A{n}", "Name": "Ann"} for n in (1, 1, 2, 3)])
    days = landed(spark, C.LANDED_DAY_VALUE, *[{"Id": d, "Meeting_Participant_MERC__c": p, "Meeting_Day_Date_MERC__c": "2020-01-11"} for d, p in (("D1", "P1"), ("D1", "P1"), ("D2", "P1"), ("D3", ""), ("D4", None))])
    events = spend.event_stage(several, RULES, RUN)
    attendees = spend.attendee_stage(people, several, accounts, RULES, RUN)
    values = spend.day_value_stage(days, people, several, RULES, RUN)
    assert attendees.columns[:4] == ["event_id_merc__c", "id", "meeting_participant_id_merc__c", "customer_id_glbl__c"]
    assert rows(attendees, "event_id_merc__c", "id", "meeting_participant_id_merc__c") == [
        (None, None, None), (None, "P1", "P1"), ("E", None, None), ("E", "", ""), ("E", "P1", "P1")
    ]
    assert rows(events, "event_id_merc__c") == [(None,), ("E",)]
    assert rows(values, "id", "meeting_participant_merc__c") == [("D1", "P1"), ("D2", "P1"), ("D3", None)]
    joined = spend.spend_join(events, attendees, values)
    assert rows(joined, "event_id_merc__c1", "id1", "id") == [("E", None, None), ("E", "", None), ("E", "P1", "D1"), ("E", "P1", "D2")]
    assert rows(spend.spend_export(joined, IDENTITY), "EventId", "ValueId", "ValueAmount") == [
        (None, None, Decimal("6.00")), ("", "_COPAY_HTL", Decimal("7.00")), ("P1", "P1_COPAY_HTL", Decimal("5.00"))
    ]
