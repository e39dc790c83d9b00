"""Text repair truth table and properties (U1-U4, F4-F6, D4, DQ1)."""

import tracemalloc
import unicodedata

import pyarrow as pa
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from fleetlake.functions import text as text_module
from fleetlake.functions.text import (REFERENCE_PAIRS, damaged_spellings, induce_mojibake,
                                      repair_reference_order, repair_string_columns, repair_text,
                                      residual_flag)

FRENCH = "é è ê ô î û ù ç É à â ë ï œ À Ç"


def latin1_damage(s):
    return s.encode("utf-8").decode("latin-1")


def cp1252_damage(s):
    # Windows-1252 reading; its five unassigned bytes pass through as C1 controls
    raw = s.encode("utf-8")
    return "".join(raw[i:i + 1].decode("cp1252", errors="ignore") or chr(raw[i]) for i in range(len(raw)))


def test_orphan_quote_rule(spark):
    # a damaged closing quote whose last byte was lost: the reference's orphan rule
    assert run(spark, ["“citation" + "â€"], repair_text) == ['“citation"']


def run(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("t"))).collect()]


def python_reference(text):
    """The reference's UDF body, restated in Python for the truth table."""
    if text is None:
        return None
    out = unicodedata.normalize("NFKC", text)
    for bad, good in REFERENCE_PAIRS:
        out = out.replace(bad, good)
    return out


def test_default_repairs_whole_text_damage(spark):
    originals = [f"le {w} du bâtiment" for w in FRENCH.split()] + ["naïve café ’quote’ 50 €", "Œuvre"]
    damaged = [latin1_damage(s) for s in originals]
    assert run(spark, damaged, repair_text) == originals


def test_default_repairs_cp1252_damage_by_table(spark):
    originals = ["l’été", "“citation”", "Élève", "œuvre", "déjà vu…"]
    damaged = [cp1252_damage(s) for s in originals]
    assert all(d != o for d, o in zip(damaged, originals))
    assert run(spark, damaged, repair_text) == originals


def test_mixed_clean_and_damaged_text(spark):
    # a genuine é next to a damaged one: round trip impossible, table repairs the rest
    mixed = "é " + latin1_damage("è") + " " + cp1252_damage("’")
    assert run(spark, [mixed], repair_text) == ["é è ’"]


def test_clean_text_untouched(spark):
    clean = ["bâtiment", "été", "plain ascii", "", None, "Ã genuine", "½ ² ﬁ"]
    assert run(spark, clean, repair_text) == clean


def test_compat_matches_reference_pairs_without_nfkc(spark):
    values = [latin1_damage("été à la fenêtre"), cp1252_damage("l’île"), None, ""]
    expected = []
    for v in values:
        if v is None:
            expected.append(None)
            continue
        out = v
        for bad, good in REFERENCE_PAIRS:
            out = out.replace(bad, good)
        expected.append(out)
    assert run(spark, values, lambda c: repair_text(c, compat=True)) == expected


def test_reference_order_nfkc_first_is_lossy(spark):
    # NFKC rewrites the continuation characters before the replacements run
    damaged = [latin1_damage(w) for w in ("è", "ê", "ô", "é", "ç")]
    got = run(spark, damaged, repair_reference_order)
    assert got == [python_reference(d) for d in damaged]
    assert got[3] == "é" and got[4] == "ç"        # survive NFKC
    assert got[0] != "è" and got[1] != "ê" and got[2] != "ô"  # destroyed (F4)


def test_lone_c3_rule_is_lossy_in_compat(spark):
    # î, û, ù share the lead byte; compat turns them into à + rubbish
    got = run(spark, [latin1_damage("î")], lambda c: repair_text(c, compat=True))
    assert got[0] != "î" and got[0].startswith("à")
    assert run(spark, [latin1_damage("î")], repair_text) == ["î"]


def test_damage_table_is_generated_and_ordered():
    table = damaged_spellings()
    lengths = [len(b) for b, _ in table]
    assert lengths == sorted(lengths, reverse=True)
    assert ("Ã©", "é") in table and ("â€™", "’") in table


def test_residual_flags(spark):
    vals = [latin1_damage("é"), "bâtiment", "â€", "ok", "bad �", None]
    assert run(spark, vals, lambda c: residual_flag(c)) == [True, False, True, False, True, None]
    # compat flags every â (F6), even correct text
    assert run(spark, ["bâtiment"], lambda c: residual_flag(c, compat=True)) == [True]


def test_string_columns_projection(spark):
    df = spark.createDataFrame([(1, latin1_damage("é"), latin1_damage("è"))], "n int, a string, b string")
    out = repair_string_columns(df).collect()[0]
    assert (out.n, out.a, out.b) == (1, "é", "è")


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(min_codepoint=32, max_codepoint=0x2FFF,
                                               exclude_categories=("Cs",)), max_size=40),
                min_size=1, max_size=8))
def test_round_trip_property(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r[0] for r in df.orderBy("i").select(repair_text(induce_mojibake("t"))).collect()]
    assert got == texts


def test_gate_skips_correct_french(spark):
    from fleetlake.functions.text import _DEFAULT_GATE
    vals = ["bâtiment", "âge", "l’été", latin1_damage("â"), cp1252_damage("’")]
    assert run(spark, vals, lambda c: c.rlike(_DEFAULT_GATE)) == [False, False, False, True, True]


def test_optional_nfkc_runs_after_repair(spark):
    df = spark.createDataFrame([(latin1_damage("ê ½ ﬁ"),)], "t string")
    assert repair_string_columns(df, normalize=True).first().t == "ê 1⁄2 fi"
    assert repair_string_columns(df).first().t == "ê ½ ﬁ"


def test_suspect_gate_is_a_superset(spark):
    # every damaged spelling in the table and every Latin-1 reading of UTF-8
    # text trips the one-pass gate; plain and correct French text does not
    from fleetlake.functions.text import _DEFAULT_PAIRS, _SUSPECT
    damaged = [bad for bad, _ in _DEFAULT_PAIRS] + [latin1_damage(w) for w in ("привет", "日本", "ß")]
    assert all(run(spark, damaged, lambda c: c.rlike(_SUSPECT)))
    assert not any(run(spark, ["bâtiment", "été", "plain", "naïve"], lambda c: c.rlike(_SUSPECT)))


def test_normalising_a_batch_holds_few_texts_as_python_strings():
    texts = ["Ã© ﬁ " + "²" * 2000, None, "", "é"] * 2000
    batch = pa.array(texts)
    for udf, pairs in ((text_module._nfkc, ()), (text_module._nfkc_then_reference_pairs, REFERENCE_PAIRS)):
        expected = []
        for value in texts[:4]:
            value = value and unicodedata.normalize("NFKC", value)
            for bad, good in pairs:
                value = value and value.replace(bad, good)
            expected.append(value)
        tracemalloc.start()
        out = udf.func(batch)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < batch.nbytes / 10
        assert out.to_pylist() == expected * 2000
        assert udf.func(batch.slice(0, 0)).to_pylist() == []
