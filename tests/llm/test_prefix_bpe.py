import random

from tokenizers import Tokenizer

from annulet.llm import prefix_bpe as P

PATH = f"{P.TOKENIZERS}/byte_bpe_50k.json"


def test_ids_equal_the_librarys():
    library = Tokenizer.from_file(PATH)
    library.encode_special_tokens = True
    rnd = random.Random(7)
    texts = ["", " ", "<|endoftext|> x", "I'LL we've 622's", "\r\n\t x​ ", "é" * 50, "🧬🧪👍🏽", "ACGT" * 500, "a" * 1000, "=====----" * 30, "环状分子 chr1", "\x00\x01"]
    texts += ["".join(rnd.choice("aeinrst '") for _ in range(200)) for _ in range(100)]
    texts += ["".join(chr(rnd.choice([rnd.randrange(32, 127), rnd.randrange(0x80, 0x3000)])) for _ in range(120)) for _ in range(60)]
    encoder = P.encoder(PATH)
    assert [encoder.encode(t) for t in texts] == [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]


def test_nulls_empties_and_other_columns(spark):
    df = spark.createDataFrame([(1, None, 5), (2, "", 6), (3, "Best,\nOdette", 7)], "doc_id bigint, text string, ids int")
    got = {r["doc_id"]: r["ids"] for r in P.encode(df, "doc_id", "text").collect()}
    assert got[1] == got[2] == [] and got[3] == P.encoder(PATH).encode("Best,\nOdette")
    counts = {r["doc_id"]: r["n_tokens"] for r in P.encode(df, "doc_id", "text", count_only=True).collect()}
    assert counts == {k: len(v) for k, v in got.items()}
    assert P.encode(df.limit(0), "doc_id", "text").count() == 0


def test_forgetting_changes_nothing():
    small = P.PrefixEncoder(PATH, remember=3, longest=2)
    text = "one two three four five one two three"
    assert small.encode(text) == P.encoder(PATH).encode(text)
