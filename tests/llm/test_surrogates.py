import re

from folioflow.llm import surrogates as s

TEXT = "Mail bo.ck2@mail8.example.com or +1 (988) 555-2485, card 4111 1111 1111 1111, ip 42.144.35.254, Maria Lopez and Иван Петров; again Maria Lopez."


def test_permutation_is_one_to_one_and_moves_everything():
    p = s.Permutation("k")
    for size in (2, 7, 300, 5000):
        image = [p("t", v, size) for v in range(size)]
        assert sorted(image) == list(range(size)) and all(a != b for a, b in enumerate(image))
    assert [p("t", v, 5000) for v in range(9)] != [s.Permutation("other")("t", v, 5000) for v in range(9)]


def test_types_formats_and_coreference(docs_frame):
    rows = [(1, TEXT), (2, "only +1 (988) 555-2485 here")]
    got = {r["doc_id"]: r for r in s.replace_entities(docs_frame(rows), "k").collect()}
    new = {e["kind"]: e["surrogate"] for e in got[1]["entities"]}
    assert [e["kind"] for e in got[1]["entities"]] == ["email", "phone", "card", "ip", "name", "name", "name"]
    for e in got[1]["entities"]:
        assert e["surrogate"] != TEXT[e["start"] : e["end"]] and e["surrogate"] in got[1]["surrogate_text"]
    assert re.fullmatch(r"[a-z]{2}\.[a-z]{2}\d@[a-z]{4}\d\.[a-z]{7}\.com", new["email"])
    assert re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4}", new["phone"]) and new["phone"] in got[2]["surrogate_text"]
    digits = [int(c) for c in new["card"] if c.isdigit()]
    assert digits[0] == 4 and s._luhn(digits[:-1]) == digits[-1] and new["card"][4] == " "
    names = [e["surrogate"] for e in got[1]["entities"] if e["kind"] == "name"]
    assert names[0] == names[2] and names[0].split()[0] in s.GIVEN["latin", "f"] and names[1].split()[0] in s.GIVEN["cyrillic", "m"]


def test_surrogates_that_occur_are_moved_on(spark):
    key, first = "k", "123-45-6789"
    permute = s.Permutation(key)
    second = s.surrogate(permute, "ssn", first)
    third = s.surrogate(permute, "ssn", second)
    entities = spark.createDataFrame([("ssn", first), ("ssn", second)], "kind string, value string")
    got = {r["value"]: r["surrogate"] for r in s.clashing(entities, key).collect()}
    assert got == {first: s.surrogate(permute, "ssn", third)}  # the third is taken by the second
    text = s.replace_entities(spark.createDataFrame([(1, f"{first} {second}")], "doc_id bigint, text string"), key).first()["surrogate_text"]
    assert len(set(text.split())) == 2 and first not in text and second not in text


def test_edge_rows(docs_frame):
    rows = [(1, None, "a"), (2, "", "b"), (None, "mail a.b@c.org", None), (2, "", "b"), (3, "word " * 100_000 + "10.20.30.40", "c")]
    df = s.replace_entities(docs_frame(rows, ", entities string"), "k")
    got = sorted((r["doc_id"] or 0, len(r["entities"])) for r in df.collect())
    assert got == [(0, 1), (1, 0), (2, 0), (2, 0), (3, 1)]
    assert s.replace_entities(docs_frame([]), "k").collect() == []


def test_names_after_any_mark_are_found():
    for before in ("(", '"', "name:", "<b>", "-"):
        text = f"see {before}Anna Smith) there"
        assert [(k, text[b:e]) for k, b, e in s.find_entities(text)] == [("name", "Anna Smith")]


def test_digits_of_any_script_keep_their_script(docs_frame):
    permute, plain = s.Permutation("k"), [("card", "4111 1111 1111 1111"), ("ssn", "123-45-6789"), ("phone", "+1 (988) 555-2485"), ("ip", "192.168.10.1")]
    for zero in (0x660, 0x6F0, 0x966, 0x1D7CE):
        script = str.maketrans("0123456789", "".join(chr(zero + k) for k in range(10)))
        for kind, value in plain:
            text = value.translate(script)
            assert s.find_entities(text) == [(kind, 0, len(text))]
            new = s.surrogate(permute, kind, text)
            assert new != text and all(zero <= ord(c) < zero + 10 for c in new if c.isdecimal())
            if kind == "card":
                digits = [int(c) for c in new if c.isdecimal()]
                assert len(digits) == 16 and s._luhn(digits[:-1]) == digits[-1]
    mixed = "1٢.1٩٢.٣.255"
    assert s.find_entities(mixed) == [("ip", 0, len(mixed))] and s.surrogate(permute, "ip", mixed) != mixed
    image = {s.surrogate(permute, "ip", f"1{chr(0x660 + k)}.0.0.{n}") for k in range(10) for n in range(256)}
    assert len(image) == 2560 and all(s.find_entities(x) == [("ip", 0, len(x))] for x in image)
    rows = s.replace_entities(docs_frame([(1, "٤١١١١١١١١١١١١١١١")]), "k").collect()
    assert len(rows) == 1 and rows[0]["surrogate_text"] != "٤١١١١١١١١١١١١١١١"


def names_in(text):
    return [text[b:e] for k, b, e in s.find_entities(text) if k == "name"]


def test_names_by_shape_and_context():
    found = {
        "ANNA SMITH was here": ["ANNA SMITH"],
        "dear Mr. Smith, hello": ["Smith"],
        "Frau Dr. von Braun came": ["von Braun"],
        "Herr von Braun came": ["von Braun"],
        "Anna O'Brien and Anna Maria Smith left": ["Anna O'Brien", "Anna Maria Smith"],
        "José García-López, María": ["José García-López"],
        "Carlos de la Vega spoke": ["Carlos de la Vega"],
        "Анна Smith or Maria Петрова": ["Анна Smith", "Maria Петрова"],
        "Anna went home": [],
        "Maria said. Then Smith": [],
        "Mr. and more": [],
        "ANNA went": [],
        "Anna B. Smith": [],
    }
    assert {t: names_in(t) for t in found} == found


def test_parts_of_a_found_name_are_replaced_alike(docs_frame):
    text = "Anna Maria Smith-Jones met Peter Brown. Later Smith-Jones told Anna that Brown left; the brown Annapolis and Browning stay."
    row = s.replace_entities(docs_frame([(1, text)]), "k").first()
    new = row["surrogate_text"]
    whole, other = [e["surrogate"] for e in row["entities"]][:2]
    first, _, last = whole.split(" ")
    assert f"Later {last} told {first} that {other.split(' ')[1]} left; the brown Annapolis and Browning stay." in new
    for part in ("Anna Maria", "Smith", "Jones", "Peter", "Brown "):
        assert part not in new


def test_every_letter_keeps_its_script():
    permute = s.Permutation("k")
    for name in ("Анна Smith", "Maria Петрова", "ANNA SMITH", "Γεώργιος Παππας", "Anna O'Brien", "Carlos de la Vega"):
        new = s.surrogate(permute, "name", name)
        assert len(new.split(" ")) == len(name.split(" ")) and new != name
        for a, b in zip(name.split(" "), new.split(" "), strict=True):
            assert a == b if a in s.PARTICLES else a != b
            assert a.isupper() == b.isupper() and ("а" <= a[-1].lower() <= "я") == ("а" <= b[-1].lower() <= "я")


def test_account_numbers_keep_valid_check_digits_and_stay_distinct():
    permute = s.Permutation("k")
    good = "DE89 3704 0044 0532 0130 00"
    assert s._iban_check(good.replace(" ", "")) == "89"
    images = set()
    for n in range(500):
        body = f"DE00{370400440532013000 + n:018d}"
        iban = body[:2] + s._iban_check(body) + body[4:]
        new = s.surrogate(permute, "iban", iban)
        assert new != iban and new[2:4] == s._iban_check(new) and new[:2] == "DE" and len(new) == len(iban)
        images.add(new)
    assert len(images) == 500
    assert [x[0] for x in s.find_entities(good)] == ["iban"] and s.surrogate(permute, "iban", good)[4] == " "


def test_addresses_of_the_longer_kind():
    permute = s.Permutation("k")
    for value in ("2001:db8:85a3:0:0:8a2e:370:7334", "fe80::1ff:fe23:4567:890a", "2001:DB8::1"):
        assert s.find_entities(f"at {value}, see") == [("ipv6", 3, 3 + len(value))]
        new = s.surrogate(permute, "ipv6", value)
        assert new != value and s.find_entities(new) == [("ipv6", 0, len(new))] and new.split(":")[0] == value.split(":")[0]
    for text in ("std::vector", "12:30:45", "a::b::c", "10:20"):
        assert [k for k, _, _ in s.find_entities(text)] == []


def test_nothing_found_survives_in_any_document(docs_frame):
    """Over a table: no found value, and no part of a found name, is left; different values stay different."""
    import random

    rng = random.Random(2)
    given = [n for names in s.GIVEN.values() for n in names]
    people = [f"{rng.choice(given)} {rng.choice(['Lopez', 'Braun', 'Смирнов', 'Keller', 'Vega-Ruiz'])}{rng.choice(['', 'a', 'en'])}" for _ in range(60)]
    values = people + [f"u{i}@mail{i % 7}.example.org" for i in range(40)] + [f"{100 + i}-{10 + i % 80}-{1000 + i}" for i in range(40)]
    rows = [(rng.choice([None, i]), " and ".join(rng.choice(values) for _ in range(8)) + ".") for i in range(120)]
    rows = [(i, t + " Later " + t.split(" ")[1] + " came") for i, t in rows]
    got = s.replace_entities(docs_frame(rows), "k").collect()
    pairs = {}
    for r in got:
        old, new = r["text"], r["surrogate_text"]
        for e in r["entities"]:
            value = old[e["start"] : e["end"]]
            assert e["surrogate"] != value
            pairs.setdefault((e["kind"], value), set()).add(e["surrogate"])
            words = new.replace(".", " ").split()
            if e["kind"] != "name":
                assert value not in new.split()
            elif not any(w in x["surrogate"].split() for x in r["entities"] for w in value.split()):
                assert not set(value.split()) & set(words)
    whole = {k: v for k, v in pairs.items() if k[0] != "name" or " " in k[1]}
    assert all(len(v) == 1 for v in whole.values())
    assert len({(k[0], *v) for k, v in whole.items()}) == len(whole)
