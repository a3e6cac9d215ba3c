"""The end-to-end cleaners on hand-made rows."""

import datetime as dt

from pyspark.sql import functions as F

from tallyloom.functions import text
from tallyloom.plans import orders, places, products, reviews, rules

ORDER_DDL = ", ".join(f"{c} string" for c in orders.ORDER_COLUMNS)


def test_orders(spark):
    day = "2018-01-{:02d} 10:00:00".format
    rows = [
        ("o1", "c1", "delivered", day(1), day(1), day(2), day(5), day(10)),
        ("o2", "c2", "delivered", day(2), day(2), day(3), None, day(12)),
        ("o3", "c3", "canceled", day(3), day(3), day(4), day(6), day(15)),
        ("o4", "c4", "canceled", day(4), None, None, None, day(20)),
        ("o5", "c5", "delivered", day(5), day(5), day(6), day(30), day(10)),
        ("o6", "c6", "delivered", day(5), day(5), day(6), day(8), None),
        ("o7", "c7", "shipped", day(5), "not a time", None, None, day(9)),
        ("o8", None, "shipped", day(5), None, None, None, day(9)),
    ]
    cleaned = orders.clean_orders(spark.createDataFrame(rows, ORDER_DDL))
    got = {r.order_id: r for r in cleaned.collect()}
    assert sorted(got) == ["o1", "o2", "o3", "o4", "o5", "o6", "o7"]
    assert {k: (v.order_status, v.delivery_performance) for k, v in got.items()} == {
        "o1": ("Delivered", "On Time"),
        "o2": ("Shipped", "In Progress"),
        "o3": ("Delivered", "On Time"),
        "o4": ("Canceled", "Canceled"),
        "o5": ("Delivered", "Delayed"),
        "o6": ("Delivered", "Delayed"),
        "o7": ("Shipped", "In Progress"),
    }
    first = got["o1"]
    assert (first.processing_time, first.delivery_time, first.estimated_delivery_time) == (0, 4, 9)
    assert (first.purchase_year, first.purchase_month, first.purchase_dayofweek) == (2018, 1, 2)
    assert got["o7"].order_approved_at is None and got["o7"].processing_time is None
    assert not any(r.is_processing_outlier or r.is_delivery_outlier for r in got.values())
    assert orders.publish_orders(cleaned).columns == list(orders.ORDER_COLUMNS)


def test_order_outliers(spark):
    rows = [(f"o{i}", "c", "delivered", "2018-01-01", "2018-01-01", None, f"2018-01-{5 + i % 3:02d}", "2018-02-01") for i in range(40)]
    rows.append(("late", "c", "delivered", "2018-01-01", "2018-01-01", None, "2018-12-31", "2018-02-01"))
    cleaned = orders.clean_orders(spark.createDataFrame(rows, ORDER_DDL))
    assert [r.order_id for r in cleaned.filter("is_delivery_outlier").collect()] == ["late"]


def test_order_items_funnel(spark):
    ok = ("o1", 1, "p", "s", "2017-05-05 00:00:00", 10.0, 1.0)
    rows = [
        ok, ok, ok,
        ("o2", 1, "p", "s", "2016-01-01 00:00:00", 0.01, 0.0),
        ("o3", 1, "p", "s", "2018-12-31 00:00:00", 10.0, 1.0),
        ("o4", 1, "p", "s", "2018-12-31 00:00:01", 10.0, 1.0),
        ("o5", 1, "p", "s", "2015-06-01 00:00:00", 10.0, 1.0),
        ("o6", 1, "p", "s", "2015-06-01 00:00:00", 0.0, 1.0),
        ("o7", 1, "p", "s", "2017-06-01 00:00:00", 10.0, -1.0),
        ("o8", 1, "p", "s", "2017-06-01 00:00:00", None, 1.0),
        ("o9", 1, "p", "s", "never", 10.0, 1.0),
    ]
    ddl = "order_id string, order_item_id int, product_id string, seller_id string, shipping_limit_date string, price double, freight_value double"
    kept, report = orders.clean_order_items(spark.createDataFrame(rows, ddl))
    assert sorted(r.order_id for r in kept.collect()) == ["o1", "o2", "o3"]
    counts = {r.stage: r.row_count for r in report.collect()}
    assert counts == {"passed": 3, "duplicate": 2, "invalid price or freight": 3, "invalid shipping date": 3}
    assert sum(counts.values()) == len(rows)


def test_payments(spark):
    rows = [
        ("o1", 1, "credit_card", 3, 100.0), ("o2", 1, "debit_card", 0, 5.0), ("o3", 1, "boleto", 1, 0.0),
        ("o4", 2, "voucher", 1, 500.999), ("o5", 1, "not_defined", None, None),
    ]
    ddl = "order_id string, payment_sequential int, payment_type string, payment_installments int, payment_value double"
    cleaned = orders.clean_payments(spark.createDataFrame(rows, ddl))
    got = {r.order_id: r for r in cleaned.collect()}
    assert [k for k, r in sorted(got.items()) if r.is_problematic] == ["o2", "o3"]
    assert got["o1"].payment_type == "Credit Card" and got["o5"].payment_type == "Not Defined"
    assert got["o4"].payment_value == 501.0
    assert dict(orders.publish_payments(cleaned).dtypes)["payment_value"] == "double"


GEO_DDL = "geolocation_zip_code_prefix int, geolocation_lat double, geolocation_lng double, geolocation_state string, geolocation_city string"


def test_geolocation_vote(spark):
    rows = [
        (1000, 1.0, 1.0, "SP", "são paulo"), (1000, 1.0, 1.0, "SP", "são paulo"), (1000, 2.0, 1.0, "SP", "sp"),
        (1000, 3.0, 1.0, "SP", "sao pualo"),
        (2000, 1.0, 1.0, "SP", "itu"), (2000, 2.0, 1.0, "SP", "itu"), (2000, 3.0, 1.0, "SP", "ituu"), (2000, 4.0, 1.0, "SP", None),
        (3000, 1.0, 1.0, "SP", "aaaa"), (3000, 2.0, 1.0, "SP", "bbbb"),
        (4000, 1.0, 1.0, "SP", "zona d'oeste"), (4000, 2.0, 1.0, "SP", "zona d'oeste"), (4000, 3.0, 1.0, "SP", "osasco"),
        (4000, 4.0, 1.0, "SP", "xy"),
    ]
    cleaned = places.clean_geolocation(spark.createDataFrame(rows, GEO_DDL))
    got = {(r.geolocation_zip_code_prefix, r.geolocation_lat): r.geolocation_city_final for r in cleaned.collect()}
    assert got == {
        ("01000", 1.0): "Sao Paulo", ("01000", 2.0): "Sao Paulo", ("01000", 3.0): "Sao Paulo",
        ("02000", 1.0): "Itu", ("02000", 2.0): "Itu", ("02000", 3.0): "Itu", ("02000", 4.0): None,
        # a tie goes to the smaller name; known and very short names are not outvoted
        ("03000", 1.0): "Aaaa", ("03000", 2.0): "Aaaa",
        ("04000", 1.0): "Zona D Oeste", ("04000", 2.0): "Zona D Oeste", ("04000", 3.0): "Osasco", ("04000", 4.0): "Xy",
    }


def test_customers(spark):
    customers = spark.createDataFrame(
        [("c1", "u1", 1234, "são paulo", "SP"), ("c2", "u2", 30000, "bh", "MG"), ("c3", "u3", 99, "RIO DE janeiro", "RJ")],
        "customer_id string, customer_unique_id string, customer_zip_code_prefix int, customer_city string, customer_state string",
    )
    lookup = spark.createDataFrame(
        [("01234", "Campinas"), ("01234", "Campinas"), ("01234", "Itu")],
        "geolocation_zip_code_prefix string, geolocation_city_final string",
    )
    got = {r.customer_id: r for r in places.clean_customers(customers, lookup).collect()}
    assert {k: (r.customer_zip_code_prefix, r.customer_city) for k, r in got.items()} == {
        "c1": ("01234", "Campinas"),
        "c2": ("30000", "Belo Horizonte"),
        "c3": ("00099", "Rio de Janeiro"),
    }
    expanded = places.clean_customers(customers, lookup, on_ambiguous="expand").collect()
    assert sorted((r.customer_id, r.customer_city) for r in expanded)[:2] == [("c1", "Campinas"), ("c1", "Itu")]
    assert len(expanded) == 4


def test_sellers(spark):
    rows = [(f"s{i}", 1234, "são paulo", " sp") for i in range(25)]
    rows += [("t1", 89, "campinas / sp", "SP"), ("t2", 5, "loja 12", "MG"), ("t3", 7, "BH", "mg"), ("t4", 7, "niteroi", "xx")]
    ddl = "seller_id string, seller_zip_code_prefix int, seller_city string, seller_state string"
    sellers = spark.createDataFrame(rows, ddl)
    got = {r.seller_id: r for r in places.clean_sellers(sellers).collect()}
    assert len(got) == len(rows)
    big = got["s0"]
    assert (big.seller_city, big.seller_state, big.seller_zip_code_prefix) == ("Sao Paulo", "SP", "01234")
    assert (big.sellers_in_city, big.sellers_in_state, big.state_market_share) == (25, 26, 89.66)
    assert (big.metropolitan_area, big.seller_region, big.seller_density) == ("Sao Paulo Metro", "Southeast", "Medium")
    assert (big.market_proximity, big.business_potential, big.city_size) == ("Core Market", "Stable", "Small City")
    assert got["t1"].seller_city == "Campinas" and got["t1"].market_proximity == "Near Market"
    assert got["t2"].seller_city is None and got["t2"].sellers_in_city == 1
    assert (got["t4"].seller_region, got["t4"].metropolitan_area) == ("Unknown", "Rio Metro")
    dropped = {r.seller_id for r in places.clean_sellers(sellers, keep_null_city=False).collect()}
    assert set(got) - dropped == {"t2"}
    assert places.publish_sellers(places.clean_sellers(sellers)).columns == list(places.SELLER_COLUMNS)


def test_categories(spark):
    pairs = [
        ("beleza_saude", "health_beauty"), ("construcao_ferramentas_construcao", "costruction_tools_construction"),
        ("utilidades_domesticas", "housewares"), ("livros_tecnicos", "books_technical"), ("bebes", "baby"),
        ("moveis_escritorio", "office_furniture"), ("industria_comercio_e_negocios", "industry_commerce_and_business"),
    ]
    raw = spark.createDataFrame(pairs, "product_category_name string, product_category_name_english string")
    got = {r.product_category_name_clean: r for r in products.clean_categories(raw).collect()}
    assert got["utilidades_domesticas"].name_similarity == 0
    assert got["construcao_ferramentas_construcao"].name_similarity == 0
    assert got["livros_tecnicos"].is_plural_consistent and got["bebes"].is_plural_consistent
    assert got["beleza_saude"].product_category_name_english_title == "Health Beauty"
    assert got["industria_comercio_e_negocios"].is_plural_consistent
    # furniture_escritorio / office_furniture
    assert got["moveis_escritorio"].name_similarity > 5


PRODUCT_DDL = (
    "product_id string, product_category_name string, product_name_lenght int, product_description_lenght int, "
    "product_photos_qty int, product_weight_g int, product_length_cm int, product_height_cm int, product_width_cm int"
)


def test_products(spark):
    rows = [(f"p{i}", "bebes", 10, 100 * i, i % 4, 100 * i, i, 10, 10) for i in range(1, 41)]
    rows += [
        ("zero", "bebes", 10, 0, 0, -5, 0, 10, 10),
        ("long", "bebes", 10, 900, 1, 900, 101, 1, 1),
        ("nocat", None, 1, 1, 1, 1, 1, 1, 1),
        ("odd", "unlisted", 1, 1, 1, 1, 1, 1, 1),
        ("edge", "bebes", 10, 900, 1, 250, 5, 10, 10),
    ]
    categories = spark.createDataFrame([("bebes", "Baby")], "product_category_name_clean string, product_category_name_english_title string")
    raw = spark.createDataFrame(rows, PRODUCT_DDL)
    got = {r.product_id: r for r in products.clean_products(raw, categories).collect()}
    assert "nocat" not in got and "odd" not in got and len(got) == 43
    zero = got["zero"]
    assert (zero.product_weight_g, zero.product_photos_qty, zero.product_volume_cm3, zero.product_density_g_cm3) == (None,) * 4
    assert (zero.volume_tier, zero.weight_category, zero.product_complexity) == ("Extra Large", "Extra Heavy", "Medium")
    assert got["p38"].product_complexity == "High" and got["p39"].product_complexity == "Very High"
    assert got["p1"].product_complexity == "Low" and got["p1"].volume_tier == "Extra Small"
    assert got["long"].shipping_complexity == "Complex" and got["p1"].shipping_complexity == "Simple"
    assert got["edge"].weight_category == "Ultra Light"
    assert got["p2"].product_density_g_cm3 == 1.0 and got["p2"].category_group == "Kids & Baby"
    kept = {r.product_id: r for r in products.clean_products(raw, categories, drop_missing=False).collect()}
    assert len(kept) == len(rows)
    assert kept["zero"].product_photos_qty == 0 and kept["odd"].category_group == "Other"


REVIEW_DDL = (
    "review_id string, order_id string, review_score string, review_comment_title string, "
    "review_comment_message string, review_creation_date string, review_answer_timestamp string"
)
AT, LATER = "2018-03-01 00:00:00", "2018-03-03 10:00:00"


def review(n, score="5", title=None, message="bom", created=AT, answered=LATER, order="o"):
    return (f"{n:032d}" if n is not None else None, order, score, title, message, created, answered)


def test_reviews(spark):
    rows = [
        review(1, "1", "Ótimo!", "  Muito  bom, RÁPIDO "), review(2), review(2), review(2, order="o2"), review(3, "0"),
        review(4, "6"), review(5, "five"), review(6, None), review(None), review(7, created="2030-01-01", answered="2030-01-02"),
        review(8, answered="2018-02-01"), review(9, created="soon"), review(10, message=" "), review(11, message=None),
    ]
    cleaned = reviews.clean_reviews(spark.createDataFrame(rows, REVIEW_DDL), as_of="2020-01-01")
    got = {(int(r.review_id), r.order_id): r for r in cleaned.collect()}
    assert sorted(got) == [(1, "o"), (2, "o"), (2, "o2"), (10, "o"), (11, "o")]
    assert got[1, "o"].review_comment_title == "otimo" and got[1, "o"].review_comment_message == "muito  bom rapido"
    assert [got[k].has_comment for k in sorted(got)] == [True, True, True, False, False]
    # statistics include the rows that only fail the date checks: scores 1, 5 x 7
    scores = [1] + [5] * 7
    mean = sum(scores) / 8
    sd = (sum((s - mean) ** 2 for s in scores) / 7) ** 0.5
    assert abs(got[1, "o"].review_score_zscore - abs(1 - mean) / sd) < 1e-9
    assert not got[1, "o"].is_outlier


def test_rated_and_translated_reviews(spark):
    rows = [review(1, message="Recomendo!"), review(2, message="ok"), review(3, message="Chegou antes do prazo e tudo certo"), review(4, message=None)]
    raw = spark.createDataFrame(rows, REVIEW_DDL)
    rated = {int(r.review_id): r for r in reviews.rate_reviews(raw).collect()}
    assert {k: r.review_quality_score for k, r in rated.items()} == {1: 0.5, 2: 0.7, 3: 1.0, 4: 1.0}
    cleaned = reviews.clean_reviews(raw, as_of="2020-01-01")
    dictionary = spark.createDataFrame([("recomendo", "&gt; i recommend. timo")], "source_text string, translated_text string")
    done = {int(r.review_id): r for r in reviews.translate_reviews(cleaned, dictionary).collect()}
    assert done[1].final_translated_message == "I recommend. Timo"
    assert done[1].cleaned_message == " i recommend. great" and done[1].was_cleaned
    assert done[2].final_translated_message == "Ok" and done[4].final_translated_message is None
    assert done[4].was_cleaned is False and done[4].chars_removed is None
    published = reviews.publish_reviews(reviews.translate_reviews(cleaned, dictionary))
    assert published.columns[:3] == ["review_id", "order_id", "review_score"] and published.count() == 4


# every name as it must come out, spelled out apart from the rule that builds the table
CORRECTED = """Sao Paulo, Rio de Janeiro, Belo Horizonte, Brasilia, Curitiba, Fortaleza, Salvador, Porto Alegre, Guarulhos,
Campinas, Sao Bernardo do Campo, Santo Andre, Osasco, Jundiai, Sao Caetano do Sul, Mogi das Cruzes, Taboao da Serra,
Itapecerica da Serra, Santana de Parnaiba, Goiania, Nova Iguacu, Ribeirao Preto, Ribeirao das Neves, Ribeirao Pires, Niteroi,
Sao Joao de Meriti, Sao Jose dos Campos, Sao Jose do Rio Preto, Feira de Santana, Varzea Grande, Sao Vicente,
Jaboatao dos Guararapes, Aparecida de Goiania, Vitoria da Conquista, Barueri, Cotia, Carapicuiba, Diadema, Suzano,
Embu das Artes"""


def test_every_city_correction(spark):
    names = [" ".join(name.split()) for name in CORRECTED.split(",")]
    assert len(names) == 40 and len(rules.CITY_CORRECTIONS) == 41
    cities = [(i, name.lower()) for i, name in enumerate(names)] + [(98, "embu"), (99, "Itu")]
    df = spark.createDataFrame(cities, "i int, c string")
    got = {r.i: r.v for r in df.select("i", text.correct_from(F.col("c"), rules.CITY_CORRECTIONS).alias("v")).collect()}
    assert got == {**dict(enumerate(names)), 98: "Embu das Artes", 99: got[99]}
    assert got[99].lower() == "itu"


def test_fixed_values():
    assert len(rules.STATE_CODES) == 27 and len(rules.ORDER_STATUSES) == 8
    assert len(rules.GENERIC_RESPONSES) == 7 and len(rules.NAME_RULES) == 10
    assert rules.CITY_CORRECTIONS["sao bernardo do campo"] == "Sao Bernardo do Campo"
    assert dt.date.fromisoformat(rules.SHIPPING_WINDOW[0]) < dt.date.fromisoformat(rules.SHIPPING_WINDOW[1])
