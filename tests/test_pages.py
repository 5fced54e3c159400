import datetime as dt
import json

from ledgerlake.plans.specs import SUBCATEGORY, TRANSACTION
from ledgerlake.session import new_scratch_path
from ledgerlake.sources.pages import map_pages, read_pages, skinny_pages

PAGE = {
    "id": "txn-0412",
    "properties": {
        "Template": {"checkbox": True},
        "Сума": {"number": 118.4},
        "Name": {"title": [{"plain_text": "Bicycle repair"}, {"plain_text": " (second part is not read)"}]},
        "Бележка": {"rich_text": []},
        "Дата": {"date": {"start": "2019-11-05"}},
        "Подкатегория": {"relation": [{"id": "sub-77"}, {"id": "sub-78"}]},
        "Година": {"relation": [{"id": "year-2019"}]},
        "Месец": {"relation": [{"id": "month-11"}]},
        "Тип": {"select": {"name": "Разход"}},
        "Статус": {"select": {"name": "Платено"}},
        "Unknown property": {"formula": {"string": "x"}},
    },
    "created_time": "2019-11-06T08:15:30.000Z", "last_edited_time": "2020-02-29T23:59:59.000Z",
}


def _land(spark, responses):
    path = new_scratch_path(spark, "pages-test")
    spark.createDataFrame([(json.dumps(r, ensure_ascii=False),) for r in responses], "value string") \
        .coalesce(1).write.text(path)
    return path


def test_mapper_one_document(spark):
    path = _land(spark, [{"object": "list", "results": [PAGE], "has_more": False, "next_cursor": None}])
    row = map_pages(read_pages(spark, path, TRANSACTION), TRANSACTION, "2026-01-01 00:00:00").first().asDict()
    assert row == {
        "id": "txn-0412", "title": "Bicycle repair", "type": "Разход", "date": "2019-11-05", "amount": 118.4,
        "status": "Платено", "note": None, "year_id": "year-2019", "month_id": "month-11", "subcategory_id": "sub-77",
        "is_template": True, "created_time": dt.datetime(2019, 11, 6, 8, 15, 30),
        "last_edited_time": dt.datetime(2020, 2, 29, 23, 59, 59), "load_date": dt.datetime(2026, 1, 1)}


def test_null_select_and_empty_lists(spark):
    p = json.loads(json.dumps(PAGE))
    p["properties"]["Тип"]["select"] = None
    p["properties"]["Статус"]["select"] = None
    p["properties"]["Name"]["title"] = []
    p["properties"]["Подкатегория"]["relation"] = []
    p["properties"]["Дата"]["date"] = None
    path = _land(spark, [{"object": "list", "results": [p]}])
    row = map_pages(read_pages(spark, path, TRANSACTION), TRANSACTION, "2026-01-01 00:00:00").first()
    assert (row["type"], row["status"], row["title"], row["subcategory_id"], row["date"]) == (None,) * 5


def test_pages_of_all_responses_are_concatenated(spark):
    def resp(ids, more):
        return {"object": "list", "results": [dict(PAGE, id=i) for i in ids], "has_more": more,
                "next_cursor": "c" if more else None}
    path = _land(spark, [resp(["a", "b"], True), resp(["c"], True), resp([], False)])
    assert sorted(r["id"] for r in read_pages(spark, path, TRANSACTION).collect()) == ["a", "b", "c"]


def test_skinny_read_prunes_properties(spark):
    sub_page = {"id": "s", "created_time": "2021-07-01T00:00:00.000Z", "last_edited_time": "2021-07-02T00:00:00.000Z",
                "properties": {"Име": {"title": [{"plain_text": "Food"}]}, "Тип": {"select": {"name": "Разход"}}}}
    path = _land(spark, [{"results": [sub_page]}])
    pages = read_pages(spark, path, SUBCATEGORY, only=["Име"])
    assert [f.name for f in pages.schema["properties"].dataType.fields] == ["Име"]
    row = skinny_pages(pages, SUBCATEGORY).first()
    assert (row["id"], row["title"], row["source_name"]) == ("s", "Food", "subcategory")
