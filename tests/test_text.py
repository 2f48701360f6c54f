import pytest
from pyspark.sql import functions as F

from loomspark.functions import text as T


def one(spark, column, *values):
    return spark.createDataFrame([values], ", ".join(f"x{i} string" for i in range(len(values)))).select(column).first()[0]




@pytest.mark.parametrize(
    ("make", "text", "want"),
    [
        (T.markdown_to_plain, None, ""),
        (T.markdown_to_plain, "# Head\n**b** and *i* `c`\n- item\n3.5mm\n> q | r", "Head\nb and i c\nitem\n5mm\nq r"),
        (T.markdown_to_plain, "2*3*4 ![alt](u) [a](b)", "234 !alt a"),
        (T.markdown_to_plain, "a < b > c<img src='x'>d", "a c d"),
        (T.markdown_to_plain, "　x　", "x"),
        (T.clean_think, "<think>a\nb</think> r\n\n\n\ns <THINK>", "r\n\ns <THINK>"),
        (T.strip_answer, "何？答案：是。", "何？"),
        (T.strip_answer, "why? answer: no ;", "why?"),
        (T.snippet, " a\nb ", "a b"),
        (T.dedup_normalise, "问题12： Why  THIS？！", "why this"),
        (T.chunk_id, " a\0b\n", "chunk-187ef4436122d1cc2f40dc2b92f0eba0"),
        (T.chunk_id, " \n", None),
        (T.question_cleanup, " 问题: a\n\nb？答案: c", "a b？"),
        (T.fallback_cleanup, "3. - 3轴怎样？", "轴怎样？"),
        (T.is_valid_question, "这个数控系统的主轴报警应该如何处理呢？", True),
        (T.is_valid_question, "太短？", False),
        (T.is_valid_question, "# this is a heading, is it not?", False),
        (T.is_valid_question, "复杂的第一个问题究竟是什么样子的呢？", False),
        (T.is_valid_question, "【x】这个数控系统的主轴报警如何处理？", False),
        (T.is_valid_question, "the Answer to everything is this, or?", False),
        (T.is_valid_question, None, False),
        (T.parse_source_ids, "a; b ,c|| d", ["a", "b", "c", "d"]),
        (T.parse_source_ids, None, []),
        (T.parse_source_ids, "A<SEP>B", ["A<SEP>B"]),
        (T.split_sources, "A<SEP>B", ["A", "B"]),
        (T.extract_entities, "请问VMC850L的主轴", []),
        (T.extract_entities, "GSK 980TDi 系统 (GSK), VMC850L. Spindle-Motor", ["GSK", "VMC850L", "Spindle-Motor"]),
        (T.bigrams, "aba", ["ab", "ba"]),
        (T.bigrams, "a", []),
        (T.bigrams, "a😀b", ["a😀", "😀b"]),
    ],
)
def test_scalar(spark, make, text, want):
    assert one(spark, make(F.col("x0")), text) == want


def test_lines_and_context(spark):
    line = T.entity_line(F.lit("A"), F.lit(""), F.lit(None).cast("string"))
    rel = T.relation_line(F.lit("A"), F.lit("B"), F.lit(""), F.lit("k"))
    assert one(spark, line, "") == "- 实体 A：暂无详细描述"
    assert one(spark, rel, "") == "- A ↔ B：关键词 k"
    none = F.array().cast("array<string>")
    assert one(spark, T.prompt_context(F.array(line), none, F.array(F.lit("s"))), "") == "【相关实体信息】\n- 实体 A：暂无详细描述\n\n【知识图谱片段】\ns"
    assert one(spark, T.prompt_context(none, none, none), "") == ""


def test_render_is_simultaneous(spark):
    got = one(spark, T.render("{a}-{b}-{c}", a=F.col("x0"), b=F.col("x1")), "{b}", "$1\\")
    assert got == "{b}-$1\\-{c}"
    assert one(spark, T.with_system(F.col("x0"), F.col("x1")), "", "p") == "p"


def test_assembly(spark):
    got = one(spark, T.assemble_document(F.lit(""), F.lit("# T"), F.array(F.lit("| a |")), F.array(T.image_text(F.lit("i.png"), F.lit(" x \n\n y")))), "")
    assert got == "T\n\n## 表格提取\n| a |\n\n## 图片OCR\n[图片OCR] i.png: x\ny"
