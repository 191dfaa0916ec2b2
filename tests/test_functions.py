import datetime as dt

from pyspark.sql import functions as F

from caretrail.functions.ids import national_id, national_id_type
from caretrail.functions.phones import caller_phone, last9_as_int, phone_to_join, user_phone
from caretrail.functions.text import mail_seen, rewrite_channel, satisfaction_reason, satisfaction_score
from caretrail.functions.timeutil import madrid_to_utc, whole_days


def one(spark, rows, schema, *cols):
    return spark.createDataFrame(rows, schema).select(*cols).collect()


def test_national_id(spark):
    rows = [("12345678A",), ("x1234567b",), ("X7654321C then 87654321Z",), ("neither 1234",), (None,),
            ("123456789A",)]
    got = one(spark, rows, "n string", national_id("n").alias("id"), national_id_type("n").alias("t"))
    assert [(r.id, r.t) for r in got] == [("12345678A", "DNI"), ("X1234567B", "NIE"), ("87654321Z", "DNI"),
                                          (None, None), (None, None), (None, None)]


def test_phones(spark):
    rows = [("Caller Phone number : +34 622 83 35 76", "+34 611 22 33 44"), ("nothing", "611 22 33 44"),
            ("Caller Phone number : 33612345678", None), (None, None)]
    got = one(spark, rows, "d string, p string", caller_phone("d").alias("c"), user_phone("p").alias("u"),
              phone_to_join(caller_phone("d"), user_phone("p")).alias("j"))
    assert [(r.c, r.u, r.j) for r in got] == [(622833576, "611223344", "622833576"),
                                              (None, "611223344", "611223344"), (None, None, None),
                                              (None, None, None)]
    got = one(spark, [("34622833576",), ("anonymous",)], "f string", last9_as_int("f").alias("x"))
    assert [r.x for r in got] == [622833576, None]


def test_text_flags(spark):
    rows = [("a unseen", "api", "via Aircall", "{score=good, reason=slow, comment=x}"),
            ("a seen", "api", "other", "score=bad"), ("unseen", None, None, None)]
    got = one(spark, rows, "tags string, ch string, d string, r string", mail_seen("tags").alias("m"),
              rewrite_channel("ch", "d").alias("c"), satisfaction_score("r").alias("s"),
              satisfaction_reason("r").alias("re"))
    assert [(r.m, r.c, r.s, r.re) for r in got] == [("unseen", "aircall", "good", "slow"), ("seen", "api", "bad", ""),
                                                    (None, None, None, None)]


def test_time(spark):
    d = dt.datetime.fromisoformat
    rows = [(d("2024-01-01 00:00:00"), d("2024-01-16 23:59:59")), (d("2024-01-01 00:00:00"), d("2024-01-17 00:00:00"))]
    got = one(spark, rows, "a timestamp_ntz, b timestamp_ntz", whole_days("a", "b").alias("w"))
    assert [r.w for r in got] == [15, 16]
    rows = [(d("2024-07-01 12:00:00"),), (d("2024-03-31 02:30:00"),), (d("2024-10-27 02:30:00"),)]
    got = one(spark, rows, "t timestamp_ntz", madrid_to_utc("t").alias("u"))
    assert [r.u for r in got] == [d("2024-07-01 10:00:00"), d("2024-03-31 01:30:00"), d("2024-10-27 00:30:00")]
