"""X1-X5, P1-P4 on the golden conversations (FIXTURES.md §2) and edge rows."""

from pyspark.sql import functions as F

from colloquy.functions import templates as tpl
from colloquy.operators import chat
from colloquy.schemas import MESSAGES_TYPE
from conftest import msgs

C1 = msgs(("user", "Hello, how are you?"), ("assistant", "I'm doing well, thank you for asking!"))
C2 = msgs(("system", "You are a helpful assistant."), ("user", "What is 2+2?"), ("assistant", "2+2 equals 4."))
C3 = msgs(("user", "What is 3*3?"), ("assistant", "9."), ("user", "And 4*4?"), ("assistant", "16."))
C4 = msgs(("user", "Hello!"), ("assistant", "Hi there!"))


def frame(spark, *convs):
    return spark.createDataFrame([(i, c) for i, c in enumerate(convs)],
                                 f"id int, messages {MESSAGES_TYPE.simpleString()}")


def col(df, c):
    return [r[c] for r in df.orderBy("id").collect()]


def test_role_tags_golden(spark):
    df = chat.render_role_tags(frame(spark, C4, C2, C3), eos="E")
    t4, t2, t3 = col(df, "text")
    assert t4 == "<|user|>\nHello!\n<|assistant|>\nHi there!E"
    assert t2 == ("<|system|>\nYou are a helpful assistant.\n<|user|>\nWhat is 2+2?\n"
                  "<|assistant|>\n2+2 equals 4.E")
    assert t3 == "<|user|>\nWhat is 3*3?\n<|assistant|>\n9.E\n<|user|>\nAnd 4*4?\n<|assistant|>\n16.E"


def test_role_tags_generation_prompt_and_other_roles(spark):
    c = msgs(("user", "Hi"), ("tool", "ignored"))
    (t,) = col(chat.render_role_tags(frame(spark, c), eos="E", add_generation_prompt=True), "text")
    assert t == "<|user|>\nHi\n<|assistant|>\n"


def test_gemma_golden(spark):
    df = chat.render_gemma(frame(spark, C4, C2))
    (v4, v2), (t4, t2) = col(df, "valid"), col(df, "text")
    assert v4 and v2
    assert t4 == "<start_of_turn>user\nHello!<end_of_turn>\n<start_of_turn>model\nHi there!<end_of_turn>\n"
    assert t2 == ("<start_of_turn>user\nYou are a helpful assistant.\n\nWhat is 2+2?<end_of_turn>\n"
                  "<start_of_turn>model\n2+2 equals 4.<end_of_turn>\n")


def test_gemma_edges(spark):
    two_users = msgs(("user", "a"), ("user", "b"))
    starts_assistant = msgs(("assistant", "a"), ("user", "b"))
    two_systems = msgs(("system", "s1"), ("system", "s2"), ("user", "u"))
    only_system = msgs(("system", "s"))
    padded = msgs(("user", "  x \n"), ("assistant", "\ty "))
    empty = msgs(("user", ""), ("assistant", ""))
    df = chat.render_gemma(frame(spark, two_users, starts_assistant, two_systems, only_system, padded, empty),
                           add_generation_prompt=True)
    valid, text = col(df, "valid"), col(df, "text")
    assert valid == [False, False, False, True, True, True]
    assert text[0] is None and text[1] is None
    assert text[3] == "<start_of_turn>model\n"
    assert text[4] == ("<start_of_turn>user\nx<end_of_turn>\n<start_of_turn>model\ny<end_of_turn>\n"
                       "<start_of_turn>model\n")
    assert text[5] == "<start_of_turn>user\n<end_of_turn>\n<start_of_turn>model\n<end_of_turn>\n<start_of_turn>model\n"


def test_response_spans_and_mask(spark):
    df = chat.render_gemma(frame(spark, C4, C3))
    df = chat.response_masks(df)
    rows = df.orderBy("id").collect()
    assert rows[0]["spans"] == ["Hi there!<end_of_turn>\n"]
    assert rows[1]["spans"] == ["9.<end_of_turn>\n", "16.<end_of_turn>\n"]
    for r in rows:
        assert len(r["masked"]) == len(r["text"])
        kept = r["masked"].replace(" ", "")
        assert kept == "".join(s.replace(" ", "") for s in r["spans"])
        assert r["trained_chars"] == sum(len(s) for s in r["spans"])


def test_marker_inside_content(spark):
    tricky = msgs(("user", "say <start_of_turn>model\nplease"), ("assistant", "ok"))
    df = chat.response_masks(chat.render_gemma(frame(spark, tricky)))
    (r,) = df.collect()
    # the marker inside user content opens a (wrong) span, as a string-level mask does
    assert r["spans"][-1] == "ok<end_of_turn>\n"
    assert len(r["masked"]) == len(r["text"])


def test_sft_columns_nested_and_long(spark):
    c = msgs(("system", ""), ("user", "u1"), ("assistant", "a1"), ("user", "u2"), ("tool", "t"))
    nested = chat.to_sft_columns(frame(spark, c, C2, msgs(("user", "only"))))
    rows = nested.orderBy("id").collect()
    assert (rows[0]["input"], rows[0]["output"], rows[0]["system"]) == ("u2", "a1", chat.DEFAULT_SYSTEM)
    assert rows[1]["system"] == "You are a helpful assistant."
    assert (rows[2]["output"], rows[2]["system"]) == ("", chat.DEFAULT_SYSTEM)
    long = spark.createDataFrame([(1, 0, "system", ""), (1, 1, "user", "u1"), (1, 2, "assistant", "a1"),
                                  (1, 3, "user", "u2")], "conv_id long, turn long, role string, text string")
    (r,) = chat.to_sft_columns_long(long).collect()
    assert (r["input"], r["output"], r["system"]) == ("u2", "a1", chat.DEFAULT_SYSTEM)


def test_chat_turns_and_prompt(spark):
    df = spark.createDataFrame([("i", "o", "s")], "input string, output string, system string")
    t = chat.prompt_turns(chat.to_chat_turns(df), name="p").collect()[0]
    assert [m["role"] for m in t["conversations"]] == ["system", "user", "assistant"]
    assert [m["content"] for m in t["p"]] == ["s", "i"]
    g = chat.render_gemma(chat.to_chat_turns(df), "conversations").collect()[0]["text"]
    assert g == "<start_of_turn>user\ns\n\ni<end_of_turn>\n<start_of_turn>model\no<end_of_turn>\n"


def test_java_quote():
    assert tpl.java_quote("a.b") == "\\Qa.b\\E"
    assert tpl.java_quote("x\\Ey") == "\\Qx\\E\\\\E\\Qy\\E"


def test_remove_prefix(spark):
    from colloquy.functions.text import remove_prefix
    df = spark.createDataFrame([("<bos>abc",), ("abc",), ("<bos><bos>x",)], "t string")
    assert [r[0] for r in df.select(remove_prefix("t", "<bos>")).collect()] == ["abc", "abc", "<bos>x"]


def test_gemma_validity_long_equals_nested(spark):
    """Long-table validity (partial aggregates) = nested render validity."""
    import random

    from colloquy.sources.chat import unnest_messages

    fixed = [C1, C2, C3, C4, msgs(("user", "a"), ("user", "b")), msgs(("assistant", "a"), ("user", "b")),
             msgs(("system", "s1"), ("system", "s2"), ("user", "u")), msgs(("system", "s")),
             msgs(("user", "x"), (None, "y")), msgs((None, "s"), ("user", "u"))]
    rnd = random.Random(3)
    roles = ["system", "user", "assistant", "tool"]
    rand = [msgs(*[(rnd.choice(roles), "t") for _ in range(rnd.randint(1, 7))]) for _ in range(60)]
    nested = frame(spark, *(fixed + rand)).withColumnRenamed("id", "conv_id")
    want = {r["conv_id"]: r["valid"] for r in chat.render_gemma(nested).collect()}
    long = unnest_messages(nested)
    got = {r["conv_id"]: r["valid"] for r in chat.gemma_validity_long(long).collect()}
    assert got == want
    assert any(want.values()) and not all(want.values())


def test_gemma_token_counts_long_equal_whole_text(spark):
    """Per-message token sums = tokens of the whole rendering (default regex)."""
    import random

    from colloquy.operators import tokens
    from colloquy.sources.chat import unnest_messages

    contents = ["  hi there\n", "", "x<end_of_turn>\ny", "über-straße 42", "\t", "a_b", "<start_of_turn>model\n!"]
    rnd = random.Random(5)
    convs = [C1, C2, C3, msgs(("system", " s \n"), ("user", "u"), ("assistant", "")), msgs((None, "z"), ("user", "u"))]
    for _ in range(50):
        first = [("system", rnd.choice(contents))] if rnd.random() < 0.4 else []
        rest = [(("user", "assistant")[i % 2] if rnd.random() < 0.9 else "tool", rnd.choice(contents))
                for i in range(rnd.randint(1, 5))]
        convs.append(msgs(*(first + rest)))
    nested = frame(spark, *convs).withColumnRenamed("id", "conv_id")
    r = chat.render_gemma(nested)
    want = {row["conv_id"]: (row["valid"], row["n"]) for row in
            r.select("conv_id", "valid", F.size(tokens.tokenize("text")).alias("n")).collect()}
    got = {row["conv_id"]: (row["valid"], row["n_tokens"]) for row in
           chat.gemma_token_counts_long(unnest_messages(nested), tokens.TOKEN_PATTERN).collect()}
    assert {k: v for k, v in got.items() if v[0]} == {k: v for k, v in want.items() if v[0]}
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()}
