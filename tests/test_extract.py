import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import extract as x
from tests.conftest import one

V1 = "Receiver : TESTUS33XXX\n32A: Value Date\nDate : 10 APR 2O25\nAmount : #30.449,84#\n59: Beneficiary Customer\n/123456\nACME TEXTILES SA"
V2 = "Receiver: TESTUS33\nInterbank Settlement Date: 2025-11-27\nInterbank Settlement Amount: USD 7297.3\nCreditor: 2100118\nACME TEXTILES SA\nCHINA"
V1_EXP = "Sender : TESTUS33XXX\n32A: Value Date\nDate : 05 Nov 2025\nAmount : #1.234,56#\n50K: Ordering Customer\n/903100\n1/1/ACME TEXTILES SA"
V2_EXP = "Sender: TESTUS33XXX\nInterbank Settlement Date: 2025-11-25\nInterbank Settlement Amount: USD7297.35\nDebtor: 2100118235\nACME TEXTILES SA\nDebtor Agent: X"


@pytest.mark.parametrize(
    "kind, version, text, want",
    [
        ("imp", "V1", V1, ("TESTUS33XXX", "2025-04-10", "30.449,84", "ACME TEXTILES SA")),
        ("imp", "V2", V2, ("TESTUS33", "2025-11-27", "7297.30", "ACME TEXTILES SA")),
        ("imp", "V2", "Creditor:\n2100118\nACME TEXTILES SA", (None, None, None, "ACME TEXTILES SA")),
        ("exp", "V1", V1_EXP, ("TESTUS33XXX", "05 Nov 2025", "1.234,56", "ACME TEXTILES SA")),
        ("exp", "V2", V2_EXP, ("TESTUS33XXX", "2025-11-25", "7297.35", "ACME TEXTILES SA")),
        *[(k, v, t, (None,) * 4) for k, v in x.FIELDS for t in ("", "\f\n", None)],
    ],
)
def test_layouts(spark, kind, version, text, want):
    df = spark.createDataFrame([(text,)], "text string")
    assert tuple(df.select(*x.fields(kind, version)).first()) == want


def test_quirks(spark):
    assert one(spark, x.amount_v1, ["32A:\nAmount : ##\n#5,00#", "32A:\n#5,#", "32A:\n1 234,5", "33B: y\nAmount: #7#", "x"]) == [None, "5,00", "1234,5", "7", None]
    assert one(spark, x.receiver_v1, ["Recei ver ; testus33", "xx Receiver\nabcdefgh"]) == ["TESTUS33", "RECEIVER"]
    assert one(spark, x.date_v1, ["Date: 5 PEB 2025", "Interbank Settlement Date: 2025-01-02\n32A:\nx"]) == ["2025-02-05", "2025-01-02"]
    assert one(spark, x.sender_v2, ["Sender:\nTRANSFER TESTUS33", "Sender:\nReceiver: TESTUS33", "Sender: MESSAGE"]) == ["TESTUS33", None, None]
    assert one(spark, x.ordering_customer, ["50F: X\n50K: Ordering Customer\n/1\nACME  SA\n70: y", "50K:\n\n33B: q\n70: y", "50F: 1/ACME\n33B: q", "50K:\n{229\n 12 3\n2/1/B C"]) == ["ACME  SA", "33B: q", "ACME", "B C"]
    assert one(spark, x.debtor_name, ["Debtor:\nUS\n12\nACME\nDebtor Agent: B", "Debtor: 12\nDebtor Agent: B", "Debtor Agent: B"]) == ["ACME", None, None]
    assert one(spark, lambda c: x.sender_v2(c, ["TESTUS33"]), ["Sender: TESTUS33 TESTUS44", "Sender: TESTUS33"]) == ["TESTUS44", None]
    assert one(spark, x.date_v1_exp, ["Date : 01 Jan 1999\n32A: v\n33B: x\nDate : 02 Jan 1999"]) == [None]


def test_first_page_wins(spark):
    pages = spark.createDataFrame([("f", "a.pdf", 1, "32A:\nDate: 10 APR 2025", None), ("f", "a.pdf", 2, V1, None)], "file_path string, file_name string, page_no int, text string, e string")
    r = x.extract(pages, "imp", "V1").first()
    assert (r.receiver, r.date, r.pages_scanned, r.estado) == ("TESTUS33XXX", "2025-04-10", 2, "Completo")
    r = x.extract(pages.withColumn("text", F.lit(V1_EXP)), "exp", "V1").first()
    assert (r.date, r.date_raw, r.pages_scanned) == ("2025-11-05", "05 Nov 2025", 2)
