"""IBANs end where their country says, whatever follows."""

import duckdb

from tests.llm.helpers import documents
from tillroll.llm.oracle import ORACLE
from tillroll.llm.pii import IBAN_LENGTHS, personal_data, span_digest

# Whole blocks of four (ES, BE, AT, PL) and not (DE, GB, NO).
IBANS = [
    "ES91 2100 0418 4502 0005 1332",
    "BE68 5390 0754 7034",
    "AT61 1904 3002 3457 3201",
    "PL61 1090 1014 0000 0712 1981 2874",
    "DE89 3704 0044 0532 0130 00",
    "GB82 WEST 1234 5698 7654 32",
    "NO93 8601 1117 947",
]


def test_sql_ends_them_too(spark):
    behind = ("", ", X", " Gracias", " BIC GEBABEBB", " 7", "x", "7", "\nan account " + IBANS[0], "iban" + IBANS[1], " ")
    texts = [f"pay {n}{b}" for iban in IBANS for n in (iban, iban.replace(" ", "")) for b in behind]
    texts += [" ".join(IBANS), ",".join(IBANS), "i" + "iban ".join(IBANS), "XX33 0000 0000 0000 7"]
    got = span_digest(personal_data(documents(spark, list(enumerate(texts))))).orderBy("doc_id").collect()
    assert sum(r["n_iban"] for r in got) > 100
    db = duckdb.connect()
    db.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    db.executemany("INSERT INTO documents VALUES (?, ?)", list(enumerate(texts)))
    rows = db.execute(f"SELECT * FROM ({ORACLE['op5_pii']}) ORDER BY doc_id").fetchall()
    assert rows == [tuple(r) for r in got]


def ibans(spark, texts):
    rows = span_digest(personal_data(documents(spark, list(enumerate(texts))))).orderBy("doc_id").collect()
    return [[s for s in r["spans"].split(",") if s.startswith("iban")] for r in rows]


def test_capitals_and_digits_behind(spark):
    texts, expected = [], []
    for iban in IBANS:
        for number in (iban, iban.replace(" ", "")):
            for behind in ("", ", X", " Gracias", " BIC GEBABEBB", " 7", " 2024 A", " A1"):
                texts.append(f"pay {number}{behind}")
                expected.append([f"iban:4:{4 + len(number)}"])
    assert ibans(spark, texts) == expected


def test_one_behind_another(spark):
    starts, at = [], 0
    for iban in IBANS:
        starts.append(f"iban:{at}:{at + len(iban)}")
        at += len(iban) + 1
    assert ibans(spark, [" ".join(IBANS), f"{IBANS[0]}7", f"{IBANS[0][:-1]}1"]) == [starts, [], []]


def test_unlisted_countries_keep_the_open_length(spark):
    plain = "000000000000"
    code = next(k for k in range(97) if int(f"{plain}3333{k:02d}") % 97 == 1)
    assert not any("XX" in names for names in IBAN_LENGTHS.values())
    assert ibans(spark, [f"XX{code:02d}{plain}."]) == [["iban:0:16"]]
