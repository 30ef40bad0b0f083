"""Shared DuckDB SQL fragments for the oracles."""

NL = "chr(10)"
# Unicode white space, by code point
WS = "(" + " || ".join(f"chr({c})" for c in (
    *range(9, 14), *range(28, 33), 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288)) + ")"


def strip(x: str) -> str:
    return f"trim({x}, {WS})"


SFT_CTE = f"""
sft AS (
  SELECT conv_id,
         coalesce(arg_max(text, turn) FILTER (WHERE role = 'user'), '') AS input,
         coalesce(arg_max(text, turn) FILTER (WHERE role = 'assistant'), '') AS output,
         coalesce(nullif(coalesce(arg_max(text, turn) FILTER (WHERE role = 'system'), ''), ''),
                  'You are a helpful AI assistant.') AS system
  FROM conversations GROUP BY conv_id
)"""

# 3-turn Gemma rendering of the SFT row (system folded into the user turn)
SFT_RENDER = (f"'<start_of_turn>user' || {NL} || system || {NL} || {NL} || {strip('input')} || "
              f"'<end_of_turn>' || {NL} || '<start_of_turn>model' || {NL} || {strip('output')} || "
              f"'<end_of_turn>' || {NL}")
SFT_PROMPT = (f"'<start_of_turn>user' || {NL} || system || {NL} || {NL} || {strip('input')} || "
              f"'<end_of_turn>' || {NL} || '<start_of_turn>model' || {NL}")

# Full-conversation Gemma rendering with the alternation rule
GEMMA_CTE = f"""
f AS (
  SELECT conv_id, arg_min(role, turn) AS first_role, arg_min(text, turn) AS first_text
  FROM conversations GROUP BY conv_id
),
l AS (
  SELECT c.conv_id, c.turn, c.role, c.text, f.first_role = 'system' AS has_sys, f.first_text,
         row_number() OVER (PARTITION BY c.conv_id ORDER BY c.turn) - 1
           - CASE WHEN f.first_role = 'system' THEN 1 ELSE 0 END AS li
  FROM conversations c JOIN f USING (conv_id)
),
lm AS (SELECT * FROM l WHERE li >= 0),
gemma AS (
  SELECT f.conv_id,
         coalesce(bool_and((lm.role = 'user') = (lm.li % 2 = 0)), true) AS valid,
         CASE WHEN coalesce(bool_and((lm.role = 'user') = (lm.li % 2 = 0)), true) THEN
           coalesce(string_agg('<start_of_turn>' || CASE WHEN lm.role = 'assistant' THEN 'model' ELSE lm.role END
                               || {NL} || CASE WHEN lm.li = 0 AND lm.has_sys THEN lm.first_text || {NL} || {NL} ELSE '' END
                               || {strip('lm.text')} || '<end_of_turn>' || {NL}, '' ORDER BY lm.turn), '')
         END AS text
  FROM f LEFT JOIN lm USING (conv_id)
  GROUP BY f.conv_id
)"""

RESPONSE = f"('<start_of_turn>model' || {NL})"
INSTRUCTION = f"('<start_of_turn>user' || {NL})"
