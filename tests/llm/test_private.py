import random
import re

from llm.corpus import no_documents, odd_documents
from pyspark.sql import functions as F

from filetide.llm import private


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def run(spark, texts, key="k"):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return [(r["text"], r["private"]) for r in private.pseudonymise(docs, key).orderBy("doc_id").collect()]


def test_valid_values_stay_valid_and_linked(spark):
    (text, kinds), (again, _), (other, _) = run(spark, [
        "mail jo.Ann+5@ex.org, card 4111 1111 1111 1111; 123-45-6789 at 10.0.0.255, GB82 WEST 1234 5698 7654 32.",
        "4111-1111-1111-1111 jo.Ann+5@ex.org", "4111111111111111"])
    assert kinds == ["email", "card", "ssn", "ip", "account"]
    found = re.fullmatch(r"mail ([a-z]{2}\.[A-Z][a-z]{2}\+\d@ex\.org), card (\d{4} \d{4} \d{4} \d{4}); (\d{3})-(\d\d)-(\d{4}) at "
                         r"([\d.]+), (GB\d\d [A-Z]{4}(?: \d{4}){3} \d\d)\.", text)
    card = found[2].replace(" ", "")
    assert luhn(card) and card != "4111111111111111" and other == card
    assert again == "-".join(found[2].split(" ")) + " " + found[1]
    assert 0 < int(found[3]) < 900 and int(found[3]) != 666 and int(found[4]) and int(found[5])
    assert all(0 <= int(x) < 256 for x in found[6].split("."))
    account = found[7].replace(" ", "")
    assert int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1


def test_invalid_values_stay(spark):
    texts = ["4111111111111112", "666-45-6789 000-12-3456 900-12-3456 123-00-4567 123-45-0000", "256.1.1.1 1.2.3.4.5",
             "GB83 WEST 1234 5698 7654 32", "2023-02-29 31/02/2020 1850-01-01 2200-01-01", "a@b", "12345"]
    assert run(spark, texts) == [(t, []) for t in texts]


def test_dates_keep_their_format(spark):
    rows = run(spark, ["2024-02-29", "29/02/2024", "29.02.2024", "12/31/1999"])
    assert [k for _, k in rows] == [["date"]] * 4
    day = rows[0][0].split("-")
    assert rows[1][0] == "/".join(reversed(day)) and rows[2][0] == ".".join(reversed(day))


def test_permutations_are_one_to_one(spark):
    pairs = spark.range(30 * 7).select(private.permute_pair(
        F.floor(F.col("id") / 7), F.col("id") % 7, (30, 7), "k", "x").alias("p")).select("p.*").collect()
    assert sorted((r["l"], r["r"]) for r in pairs) == [(a, b) for a in range(30) for b in range(7)]
    for size in (1, 3):
        out = spark.range(10 ** size).select(private.permute_letters(
            F.lpad(F.col("id").cast("string"), size, "0"), "k", "x").alias("p")).collect()
        assert sorted(r["p"] for r in out) == [f"{i:0{size}}" for i in range(10 ** size)]


def test_keys_differ(spark):
    assert run(spark, ["4111111111111111"], "k") != run(spark, ["4111111111111111"], "l")


def test_odd_documents_keep_their_columns(spark):
    docs = odd_documents(spark)
    done = private.pseudonymise(docs, "k")
    assert done.columns == [*docs.columns, "private"]
    plain = sorted([tuple(r) for r in docs.collect()], key=repr)
    assert sorted([tuple(r)[:-1] for r in done.collect()], key=repr) == plain
    assert private.pseudonymise(no_documents(spark), "k").collect() == []


def account(country, body):
    number = int("".join(str(int(c, 36)) for c in body + country + "00"))
    return f"{country}{98 - number % 97:02}{body}"


def spaced(value):
    return " ".join(value[i:i + 4] for i in range(0, len(value), 4))


def test_values_beside_other_numbers(spark):
    """Cards beside expiry, CVV or a number, two phones, accounts before a capital word."""
    card, solid = "4111 1111 1111 1111", "4111111111111111"
    texts = [card, solid, f"card {solid} 12/26", f"2 {card}", f"{card} 123", "4111 1111 1111 1111 12 4111-1111-1111-1111",
             "5105 1051 0510 5100 4111 1111 1111 1111", "378282246310005 12/26 1234", f"{card[:-1]}2 7 {solid}"]
    rows = run(spark, texts)
    new, plain_new = rows[0][0], rows[1][0]
    assert new.replace(" ", "") == plain_new != solid
    assert [t for t, _ in rows[2:5]] == [f"card {plain_new} 12/26", f"2 {new}", f"{new} 123"]
    assert rows[5] == (f"{new} 12 {new.replace(' ', '-')}", ["card"] * 2)
    assert rows[6][1] == ["card"] * 2 and rows[6][0].endswith(new) and rows[7][1] == ["card"]
    assert rows[8] == (f"{card[:-1]}2 7 {plain_new}", ["card"])


def test_phones_beside_each_other(spark):
    one, two, (both, kinds) = run(spark, ["555-123-4567", "555-987-6543", "555-123-4567 555-987-6543"])
    assert both == f"{one[0]} {two[0]}" and kinds == ["phone"] * 2 and one[0] != "555-123-4567"


def test_accounts_before_capital_words(spark):
    values = ["BE68 5390 0754 7034", "ES91 2100 0418 4502 0005 1332", "GB82 WEST 1234 5698 7654 32", "NO93 8601 1117 947",
              spaced(account("DE", "370400440532013000"))]
    alone = run(spark, values)
    for word in ("EUR", "USD PAID", "X"):
        assert run(spark, [f"{v} {word}" for v in values]) == [(f"{new} {word}", ["account"]) for new, _ in alone]
    assert all(new != v for (new, _), v in zip(alone, values))


def test_other_formats_in_a_failed_stretch(spark):
    texts = ["12 555-123-4567 98", "4111 1111 1111 1112 jo@ex.org", "666-45-6789 123-45-6789", "1234567890123 2024-02-29"]
    assert [k for _, k in run(spark, texts)] == [["phone"], ["email"], ["ssn"], ["date"]]


def test_cards_with_any_neighbours(spark):
    rng = random.Random(6)
    texts = []
    for _ in range(300):
        body = rng.choice("3456") + "".join(rng.choice("0123456789") for _ in range(14))
        card = next(body + c for c in "0123456789" if luhn(body + c))
        texts.append((spaced(card), rng.choice(["", "7 ", "no. 12 "]), rng.choice([" 123", " 12/26", " 12 34", ""])))
    rows = run(spark, [a + c + b for c, a, b in texts])
    for (card, before, after), (text, kinds) in zip(texts, rows):
        assert "card" in kinds and text.startswith(before) and card not in text


def real_code(code):
    return 200 <= int(code) <= 999 and code[1:] != "11"


def test_phones_keep_what_can_exist(spark):
    numbers = spark.range(1000).select(F.concat(F.lpad(F.col("id").cast("string"), 3, "0"), F.lit("5550147")).alias("n")).union(
        spark.range(1000).select(F.concat(F.lit("212"), F.lpad(F.col("id").cast("string"), 3, "0"), F.lit("0147")))).distinct()
    out = [(r["n"], r["p"]) for r in numbers.select("n", private.permute_phone(F.col("n"), "k").alias("p")).collect()]
    assert len({p for _, p in out}) == len(out) == 1999 and all(len(p) == 10 and p.isdigit() for _, p in out)
    for n, p in out:
        assert (real_code(n[:3]), real_code(n[3:6])) == (real_code(p[:3]), real_code(p[3:6]))
    codes = spark.range(1000).select(private._code(F.col("id").cast("int")).alias("c")).select(
        private._from_code(F.col("c.real"), F.col("c.place")).alias("c")).collect()
    assert [int(r["c"]) for r in codes] == list(range(1000))


def test_addresses_stay_in_their_blocks(spark):
    import ipaddress

    firsts = [*range(256)] + [100, 169, 172, 192, 198] * 40
    rows = [(a, (i * 37) % 256 if i % 3 else {100: 70, 169: 254, 172: 20, 192: 168, 198: 18}.get(a, i % 256), i % 256, 7)
            for i, a in enumerate(firsts)]
    rows = sorted(set(rows))
    out = spark.createDataFrame(rows, "a int, b int, c int, d int").select(
        "a", "b", "c", "d", private.permute_address(F.concat_ws(".", *"abcd"), "k").alias("p")).collect()
    assert len({r["p"] for r in out}) == len(rows)
    for r in out:
        old, new = ipaddress.ip_address(f"{r['a']}.{r['b']}.{r['c']}.{r['d']}"), ipaddress.ip_address(r["p"])
        for block in ("0.0.0.0/8", "10.0.0.0/8", "100.64.0.0/10", "127.0.0.0/8", "169.254.0.0/16", "172.16.0.0/12",
                      "192.168.0.0/16", "198.18.0.0/15", "224.0.0.0/3"):
            assert (old in ipaddress.ip_network(block)) == (new in ipaddress.ip_network(block))


def test_long_texts(spark):
    """Many repetitions of a pattern's parts overflow no stack."""
    n = 1 << 12
    texts = ["a@b" + ".c" * (1 << 19), "a" * n + "@b.c", "AB12" + " ABCD" * n, "1" * n, "1-" * n, "1." * n, "2024-" * n,
             "(212) " * n, "+1 " * n]
    rows = run(spark, texts)
    assert len(rows) == len(texts) and rows[0][1] == ["email"] and rows[0][0].endswith("@b" + ".c" * (1 << 19))
    assert run(spark, ["jo@ex.org, " * 1_000])[0][1] == ["email"] * 1_000
