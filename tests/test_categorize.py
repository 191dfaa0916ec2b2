from pyspark.sql import functions as F

from caretrail.functions.categories import CALL_INCIDENTS, CALL_LINES, TICKET_INCIDENTS, ladder
from caretrail.operators.categorize import categorize


def vocabulary(rs):
    words = set()
    for r in rs.rules:
        for p in r.patterns:
            core = p.replace("%", "")
            words |= {p, core, core.upper(), core.replace("_", " "), "x" + core + "y"}
    return sorted(words) + ["", "zzz"]


def test_rulesets_parsed():
    assert len(TICKET_INCIDENTS.rules) == 129
    assert len(CALL_INCIDENTS.rules) == 127
    assert len(CALL_LINES.rules) == 15


def test_compiled_equals_ladder(spark):
    for rs in (TICKET_INCIDENTS, CALL_INCIDENTS, CALL_LINES):
        words = vocabulary(TICKET_INCIDENTS) + vocabulary(CALL_INCIDENTS) + vocabulary(CALL_LINES)
        df = spark.createDataFrame([(w,) for w in words] + [(None,)], "v string")
        got = categorize(df, "v", rs, "label").withColumn("want", ladder(F.col("v"), rs))
        bad = got.where(~F.col("label").eqNullSafe(F.col("want"))).collect()
        assert not bad, (rs.name, bad[:5])


def test_known_labels(spark):
    vals = ["google", "qyr", "proveedores__inbound", "modificación__interrumpimos__otros", "Llamada perdida",
            "", None, "Cotización__Contratada", "modificación__no_interrumpimos", "llamada_perdida__no_contesta"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    z = {r["v"]: r["z"] for r in categorize(df, "v", TICKET_INCIDENTS, "z").collect()}
    a = {r["v"]: r["a"] for r in categorize(df, "v", CALL_INCIDENTS, "a").collect()}
    assert z["google"] == "feedback request" and a["google"] == "Others"
    assert z["qyr"] == "complaints" and a["qyr"] == "Others"
    assert z["proveedores__inbound"] == "providers" and a["proveedores__inbound"] == "Others"
    assert z["modificación__interrumpimos__otros"] == "request for amendment"
    assert a["modificación__interrumpimos__otros"] == "Interruptions"
    assert z["Llamada perdida"] == "llamada perdida" == a["Llamada perdida"]
    assert z[""] == "others" and a[""] == "Others"
    assert z[None] == "others" and a[None] == "Others"
    assert z["Cotización__Contratada"] == "purchase support" == a["Cotización__Contratada"]
    assert z["modificación__no_interrumpimos"] == "interruptions" == a["modificación__no_interrumpimos"].lower()
    assert z["llamada_perdida__no_contesta"] == "llamada perdida"


def test_line_classification(spark):
    df = spark.createDataFrame([(v,) for v in ["NPS Ventas", "nps x", "Rastreator", "PW 3 - Gestion poliza",
                                               "Pruebas", "other", None]], "v string")
    got = {r["v"]: r["c"] for r in categorize(df, "v", CALL_LINES, "c").collect()}
    assert got == {"NPS Ventas": "NPS", "nps x": None, "Rastreator": "Ventas",
                   "PW 3 - Gestion poliza": "Gestion poliza", "Pruebas": "NPS", "other": None, None: None}
