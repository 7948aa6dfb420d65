"""Hand-made store tables and dates for the tests of the store's queries."""

from __future__ import annotations

import datetime as dt

from cartwise.sources.tables import StoreTables

AS_OF = dt.date(2001, 7, 15)


def D(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def make_tables(spark, customers=None, orders=None, lines=None, items=None, categories=None,
                item_categories=None, reviews=None, states=None, kinds=None) -> StoreTables:
    """Hand-made store tables (column order as in ``load_tables``)."""
    customers = customers if customers is not None else []
    cust = spark.createDataFrame(customers, "id bigint, name string, birthdate date, sex string, state string")
    order = spark.createDataFrame(orders or [], "id bigint, customer_id bigint, date date, totalPrice double")
    li = spark.createDataFrame(lines or [], "order_id bigint, item_id bigint, quantity int")
    item = spark.createDataFrame(items or [], "id bigint, title string, brand string, description string, "
                                              "imUrl string, price double")
    cat = spark.createDataFrame(categories or [], "id int, name string")
    ic = spark.createDataFrame(item_categories or [], "items_id bigint, categories_id int")
    rv = spark.createDataFrame(reviews or [], "customer_id bigint, item_id bigint, overall double, "
                                              "helpful int, unhelpful int, date date")
    sm = spark.createDataFrame(states if states is not None else [("Ohio", "OH"), ("Utah", "UT")],
                               "name string, abbreviation string")
    tag = spark.createDataFrame([], "item_id bigint, tag string")
    kind = spark.createDataFrame(kinds or [], "item_id bigint, kind string")
    return StoreTables(customer=cust, order=order, ordereditem=li, item=item, category=cat,
                       item_category=ic, review=rv, state_map=sm, item_tag=tag, item_kind=kind)


def item_row(i: int, brand: str | None = "B1", price: float = 1.0):
    return (i, f"title{i}", brand, f"desc{i}", f"img/{i}.jpg", price)
