from annulet.llm import pii, pii_kernel as K

WORDS = [("Odette", "given"), ("Tavish", "given"), ("Harkin", "given"), ("Noreen", "given"), ("Branvant", "family"), ("Lumquist", "family"), ("Pelossa", "family"), ("May", "either"), ("Grant", "either"), (None, None)]


def corpus():
    names = ["Odette Branvant", "Tavish Lumquist", "Harkin Pelossa", "Noreen Branvant", "Orsolya Lumquist", "Odette Wexrell", "Tavish Wexrell", "Orsolya Wexrell"]
    texts = []
    for i, n in enumerate(names * 3):
        texts += [f"Thanks,\n{n}\n555-01{i:02d}", f"Best,\n{n}\n+44 7700 9003{i:02d}", f"Contact: {n}, phone +1 (555) 012-{5400 + i}", f"Samples of {n} were pooled.", f"I talked to {n} about it. Catalogue no. 495-01{i:02d} came."]
        texts += [f"We met at {i + 1} Cinder Street, Novigrade 1234{i % 10} today.", f"Return address: {i + 1} Mill Lane, Novigrade One read fits."]
        texts += [f"The ID card ZT-62{i:02d}-0056-G belongs to {n}.", f"The ID card 666-25-09{i:02d} belongs to {n}. See lot 740-28-11{i:02d}."]
    texts += ["According to the Wexrell Protocol it works. Grant Stone buffer and May agar are kits.", "ask orsolya whether chr1 was masked", None, "", "   ", "x" * 200_000]
    return texts


def model(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(corpus())], "doc_id bigint, text string")
    return docs, pii.learned(docs, spark.createDataFrame(WORDS, "word string, word_kind string"))


def held(table):
    rows = table.collect()
    return pii.model_of([r["kind"] for r in rows], [r["v"] for r in rows])


def shown(text, m):
    return [(k, text[s:e]) for k, s, e in K.find(text, m)]


def test_bootstrapped_names_contexts_and_decoys(spark):
    docs, table = model(spark)
    m = held(table)
    assert {"orsolya"} <= m.name and "may" not in m.name and "Novigrade" in m.town
    assert "AA-9999-9999-A" in m.id_shape and "999-99-9999" not in m.id_shape and "999-9999" not in m.phone_shape
    assert shown("Samples of Orsolya Wexrell were pooled.", m) == [("person", "Orsolya Wexrell")]
    assert shown("According to the Wexrell Protocol it works.", m) == []
    assert shown("Grant Stone buffer and May agar are kits.", m) == []
    assert shown("ask orsolya whether it is", m) == [("person", "orsolya")]
    assert shown("Catalogue no. 495-0142 came, lot 740-28-1182.", m) == []
    assert shown("The ID card 666-25-0999 belongs to Odette Branvant.", m) == [("id_number", "666-25-0999"), ("person", "Odette Branvant")]
    assert shown("Return address: 3 Mill Lane, Novigrade One read fits.", m) == [("address", "3 Mill Lane, Novigrade")]
    assert shown("Thanks,\nTavish Lumquist\n555-0143", m) == [("person", "Tavish Lumquist"), ("phone", "555-0143")]
    rows = pii.find(docs, table).collect()
    places = {}
    for r in rows:
        places.setdefault(r["doc_id"], []).append((r["start_pos"], r["end_pos"]))
    for spans in places.values():
        spans.sort()
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_forms_of_emails():
    m = K.Model()
    for text, want in {
        "write to a.b+c@lab7.arvela.test.": "a.b+c@lab7.arvela.test", "x [at] biobank [dot] example ok": "x [at] biobank [dot] example", "radko AT mail DOT hesper DOT test": "radko AT mail DOT hesper DOT test",
        "maelis(at)lab9.test bounced": "maelis(at)lab9.test", "q @ genlab.example,": "q @ genlab.example", "<u_v@x-y.example>": "u_v@x-y.example", "请联系 e@s.invalid。": "e@s.invalid",
    }.items():
        assert shown(text, m) == [("email", want)]
    assert shown("Reads@Q20 went up, @all", m) == []


def test_redaction_and_empty_inputs(spark):
    docs, m = model(spark)
    text = pii.redact(docs.where("doc_id = 2"), m).first()["text"]
    assert text == "Contact: [PERSON], phone [PHONE]"
    kept = {r["doc_id"]: r["text"] for r in pii.redact(docs.where("text is null or trim(text) = '' or length(text) > 1000"), m).collect()}
    assert kept == {i: t for i, t in enumerate(corpus()) if t is None or not t.strip() or len(t) > 1000}
    empty = docs.limit(0)
    none = pii.learned(empty, spark.createDataFrame([], "word string, word_kind string"))
    assert pii.find(empty, none).count() == 0 and none.count() == 0


def test_a_model_too_large_to_be_sent_stays_a_table(spark, monkeypatch):
    docs, m = model(spark)
    want = sorted(map(tuple, pii.find(docs, m).collect()))
    texts = {r["doc_id"]: r["text"] for r in pii.redact(docs, m).collect()}
    monkeypatch.setattr(pii, "MOST", 5)
    assert sorted(map(tuple, pii.find(docs, m).collect())) == want and len(want) > 100
    assert {r["doc_id"]: r["text"] for r in pii.redact(docs, m).collect()} == texts


# Numbers and addresses in forms that the other tests' texts don't have, in sentences with and without a word for them.
FORMS = {
    "id_number": ["QQ 12 34 {:02d} C", "85{:02d}09-9805", "1101051949{:02d}1002X", "1 85 05 78 006 {:03d} 36", "123{:05d}Z", "ABCD{:06d}"],
    "phone": ["138123{:05d}", "07911 12{:04d}", "(0)20 7946 {:04d}", "06.12.34.{:02d}.78", "02 123 {:02d} 67"],
}
SAID = {"id_number": ["the passport {} of the donor", "identity card {} was copied", "护照{}，"], "phone": ["call {} at noon", "phone {} or fax", "电话{}，"]}
PLAIN = {"id_number": ["Form signed, holder of {} agreed.", "Badge of visitor: {}, valid today."], "phone": ["Reachable under {}, mornings only.", "Ring back on {}, please."]}
DECOYS = ["Lot 12 34 {:02d} C was used.", "Barcode 99-12-{:06d}.", "Position {:07d}-9000000 on chr5.", "Dates are written as 2025-02-{:02d} here."]


def test_recall_and_precision_on_other_formats(spark):
    """Learned on one half of the numbers, measured on the other half, in sentences that say nothing about the kind."""
    texts = [d.format(i) for i in range(40) for d in DECOYS]
    for kind, shapes in FORMS.items():
        for f in shapes:
            texts += [s.format(f.format(i)) for i in range(12) for s in SAID[kind]] + [s.format(f.format(i)) for i in range(6) for s in PLAIN[kind]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    m = held(pii.learned(docs, spark.createDataFrame(WORDS, "word string, word_kind string")))
    true = found = right = 0
    for kind, shapes in FORMS.items():
        for n, f in enumerate(shapes):
            for i in range(50, 60):
                number = f.format(i)
                for s in PLAIN[kind]:
                    got = [x for x in shown(s.format(number), m) if x[0] in ("phone", "id_number")]
                    true, found, right = true + 1, found + len(got), right + ((kind, number) in got)
    wrong = sum(len(shown(d.format(i), m)) for i in range(50, 60) for d in DECOYS)
    assert right >= 0.9 * true and right >= 0.9 * (found + wrong), (true, found, right, wrong)


def test_addresses_and_names_in_other_forms():
    m = K.Model(name={"王小明"}, street={"quay"})
    for text, want in {
        "at 1600 Penn Avenue NW, Washington, DC 20500 now": ("address", "1600 Penn Avenue NW, Washington, DC 20500"),
        "in Via Roma 12, 00184 Roma": ("address", "Via Roma 12, 00184 Roma"),
        "to 5 Harbour Quay, Dunmarch 12345": ("address", "5 Harbour Quay, Dunmarch 12345"),
        "寄到北京市海淀区中关村路12号": ("address", "寄到北京市海淀区中关村路12号"),
        "请找李小龙医生": ("person", "李小龙"), "联系人：赵云": ("person", "赵云"), "昨天王小明来了": ("person", "王小明"),
    }.items():
        assert want in shown(text, m), (text, shown(text, m))
    assert shown("to 5 Harbour Quag, Dunmarch 12345", m) == []


def test_street_words_are_learned(spark):
    streets = ["Street", "Lane", "Quay"]
    texts = [f"Send it to {i} Old {s}, Dunmarch 1234{i % 10} today." for i in range(1, 9) for s in streets] + [f"We saw {i} Blue Dots, Arvela was there." for i in range(9)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert held(pii.learned(docs, spark.createDataFrame(WORDS, "word string, word_kind string"))).street == {"quay"}
