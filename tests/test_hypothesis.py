"""Property tests: column functions against plain-Python statements of the rules.

Strings are drawn from a small ASCII alphabet (letters, digits, '@', '-',
sentence punctuation, spaces, tabs) where Java and Python regex semantics
coincide. (They differ on line terminators: Java's '.' also excludes '\r',
so Spark leaves an email starting with '\r' unmasked where Python's re
would mask it; Spark's behaviour is the one the datasets define.) Each
example is one DataFrame, so Spark runs few jobs.
"""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hearthlake import params
from hearthlake.functions import chunk_sentences, clean_review_text, lexicon_score, mask_email, mask_phone

ALPHABET = "abcdeAZ019@-.!?, \t"
TEXT = st.text(alphabet=ALPHABET, max_size=30)
WORDY = st.lists(st.sampled_from(["good", "bad", "slow", "fresh", "bread", "great", "cold", "x", ".", "!", " "]),
                 max_size=12).map("".join)
SETTINGS = settings(max_examples=6, deadline=None, derandomize=True,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def py_mask_email(s):
    return None if s is None else re.sub(r"(^.).*(@.*$)", r"\1***\2", s.lower())


def py_mask_phone(s):
    return None if s is None else re.sub(r"(\d{0,3})\d+(\d{2})$", r"\1****\2", s)


def py_chunks(s):
    clean = re.sub(r"[^a-z0-9 \t\n\x0b\f\r.!?]", " ", s.lower())
    return [t.strip(" ") for t in re.split(r"[.!?]+", clean) if t.strip(" ")]


def py_score(chunk):
    if any(w in chunk for w in params.POSITIVE_WORDS):
        return 1.0
    if any(w in chunk for w in params.NEGATIVE_WORDS):
        return -1.0
    return 0.0


def spark_values(spark, values, fn):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [r[0] for r in df.select(fn(F.col("v"))).collect()]


@SETTINGS
@given(st.lists(TEXT, min_size=1, max_size=40))
def test_masks_match_their_regex_rules(spark, values):
    assert spark_values(spark, values, mask_email) == [py_mask_email(v) for v in values]
    assert spark_values(spark, values, mask_phone) == [py_mask_phone(v) for v in values]


@SETTINGS
@given(st.lists(st.one_of(TEXT, WORDY), min_size=1, max_size=40))
def test_chunking_matches_sentence_split(spark, values):
    got = spark_values(spark, values, lambda c: chunk_sentences(clean_review_text(c)))
    assert got == [py_chunks(v) for v in values]


@SETTINGS
@given(st.lists(WORDY, min_size=1, max_size=40))
def test_lexicon_score_matches_rule(spark, values):
    got = [float(x) for x in spark_values(spark, values, lexicon_score)]
    assert got == [py_score(v) for v in values]


TX_ROW = st.tuples(
    st.sampled_from(["t1", "t2", "t3", "t4"]),        # few ids: many copies per id
    st.integers(min_value=0, max_value=3),            # few timestamps: frequent ties
    st.integers(min_value=0, max_value=3),            # quantity, 0 is invalid
    st.sampled_from(["0.00", "1.25", "2.50"]),        # unit price, 0 is invalid
    st.one_of(st.none(), st.sampled_from(["1.00", "9.99"])),  # total, NULL gets back-filled
    st.integers(min_value=1, max_value=3),            # customer (3 is unknown)
    st.integers(min_value=1, max_value=2),            # store
    st.sampled_from(["bun", "tart"]),
)


@SETTINGS
@given(st.lists(TX_ROW, min_size=1, max_size=25))
def test_silver_daily_and_spend_match_brute_force(spark, rows):
    from datetime import datetime, timedelta

    from builders import customer, sources, store, supplier, tx
    from hearthlake.plans.medallion import Medallion
    from test_skew import brute_force

    t0 = datetime(2024, 5, 13, 9)
    txs = [tx(tid, t0 + timedelta(hours=h), qty=q, unit=u, total=t, cust=c, store_id=s, product=p)
           for tid, h, q, u, t, c, s, p in rows]
    g = Medallion(sources(spark, customers=[customer(1), customer(2)], franchises=[store(1), store(2)],
                          suppliers=[supplier(1)], transactions=txs))
    ids, daily, spend, top = brute_force(txs, customers={"1", "2"}, stores={"1", "2"})
    assert {r.transaction_id for r in g["silver_pos_transactions"].collect()} == ids
    assert {(r.store_id, r.reporting_date): (r.total_daily_revenue, r.total_items_sold, r.avg_transaction_value)
            for r in g["gold_daily_franchise_health"].collect()} == daily
    c360 = {r.customer_id: r for r in g["gold_customer_360"].collect()}
    assert {c: r.total_lifetime_spend for c, r in c360.items()} == spend
    assert {c: r.most_frequent_product for c, r in c360.items()} == top
