"""Raw CSV files to published tables, end to end."""

from tallyloom.operators.reconcile import count_reconcile, parity
from tallyloom.plans import refresh, schema

A, B = "a" * 32, "b" * 32
RAW = {
    "customers": f"{A},u1,1234,sao paulo,SP\n{B},u2,99,rj,RJ\n",
    "geolocation": "1234,-23.5,-46.6,são paulo,SP\n1234,-23.5,-46.6,são paulo,SP\n1234,-23.6,-46.6,sao pualo,SP\n"
    "1234,-23.7,-46.6,sp,ZZ\n",
    "order_items": f"{A},1,p1,s1,2017-05-05 10:00:00,10.5,1.0\n{A},1,p1,s1,2017-05-05 10:00:00,10.5,1.0\n"
    f"{B},1,p9,s1,2017-05-05 10:00:00,0,1.0\n",
    "order_payments": f"{A},1,credit_card,2,10.5\n{B},1,cash,0,1\n",
    "order_reviews": f'{A},{A},5,,"Muito ""bom"",\nrecomendo",2018-01-01 00:00:00,2018-01-02 00:00:00\n'
    f"{B},{A},9,,ruim,2018-01-01 00:00:00,2018-01-02 00:00:00\n",
    "orders": f"{A},{A},delivered,2017-05-01 10:00:00,2017-05-01 11:00:00,2017-05-02 00:00:00,2017-05-08 00:00:00,2017-05-20 00:00:00\n"
    f"{B},c9,lost,2017-05-01 10:00:00,,,,2017-05-20 00:00:00\n",
    "products": "p1,bebes,10,100,1,500,10,10,10\np2,,10,100,1,500,10,10,10\n",
    "product_category": "bebes,baby\n",
    "sellers": "s1,89,são paulo/sp,sp\n",
}


def test_refresh(spark, tmp_path):
    sources = {}
    for name, body in RAW.items():
        header = ",".join(field.split()[0] for field in schema.TABLES[name].split(", "))
        (tmp_path / f"{name}.csv").write_text(header + "\n" + body)
        sources[name] = str(tmp_path / f"{name}.csv")
    raw, ready = str(tmp_path / "raw"), str(tmp_path / "ready")
    landed = refresh.land_raw(spark, sources, raw)
    assert {p.path.split("/")[-1].split(".")[0]: p.rows_read for p in landed} == {
        "customers": 2, "geolocation": 4, "order_items": 3, "order_payments": 2, "order_reviews": 2, "orders": 2,
        "products": 2, "product_category": 1, "sellers": 1,
    }

    dictionary = spark.createDataFrame([("muito bom\nrecomendo", "very good. i recommend")], "source_text string, translated_text string")
    done = refresh.clean_all(spark, raw, ready, "2020-01-01", dictionary)
    assert all(p.verified for p in done.values())
    rows = {name: p.rows_read for name, p in done.items()}
    assert (rows["geolocation"], rows["order_items"], rows["order_reviews"], rows["products"]) == (3, 1, 1, 1)
    names = refresh.publish_names(spark, ready, list(done), str(tmp_path / "stored"))
    cities = {r.customer_city for r in names["vw_customers"].collect()}
    assert cities == {"Sao Paulo", "Rio de Janeiro"}
    assert names["ext_order_reviews"].first().final_translated_message == "Very good. I recommend"
    assert names["vw_products"].first().product_category_name == "Baby"
    assert names["vw_sellers"].first().asDict() == {
        "seller_id": "s1", "seller_zip_code_prefix": "00089", "seller_city": "Sao Paulo", "seller_state": "SP",
    }
    funnel = {r.stage: r.row_count for r in spark.read.parquet(f"{ready}/order_items_funnel").collect()}
    assert funnel == {"passed": 1, "duplicate": 1, "invalid price or freight": 1}
    both = parity(names["vw_orders"], names["ext_orders"], "order_status", ("view", "table")).collect()
    assert both[0][1:] == both[1][1:]
    assert count_reconcile(names["vw_orders"], names["ext_orders"], "orders").first().status == "match"


def test_audit(spark, tmp_path):
    tables = {}
    for name, body in RAW.items():
        (tmp_path / f"{name}.csv").write_text(body)
        tables[name] = spark.read.csv(str(tmp_path / f"{name}.csv"), schema.TABLES[name], multiLine=True, escape='"')
    reports = schema.audit(tables)
    keys = {r.table_name: r.is_key for r in reports["keys"].collect()}
    assert keys == {name: name != "order_items" for name in schema.KEYS}
    broken = {(r.table_name, r.rule): r.violations for r in reports["constraints"].collect() if r.violations}
    assert broken == {
        ("geolocation", "valid_state"): 1, ("order_items", "price_positive"): 1, ("order_payments", "valid_payment_type"): 1,
        ("order_reviews", "score_1_to_5"): 1, ("orders", "valid_order_status"): 1, ("sellers", "valid_state"): 1,
    }
    lost = {r.relation: r.orphan_rows for r in reports["references"].collect() if r.orphan_rows}
    assert lost == {"orders.customer_id": 1, "order_items.product_id": 1}
