"""Constants that define behaviour.

Fixed values: these must equal the original training code's values for equal results.
  ignore label          -100
  end-of-document text  <|endoftext|>
  end-of-turn text      <|eot_id|>
  right-pad text        <|finetune_right_pad_id|>
  GPT-2 vocabulary size 50257

Our own choices (not taken from anywhere): the word-tokenizer pattern below, the
chat-template markup tokens (the public Llama-3 header names), and the reserved
id layout of the byte tokenizer.
"""

IGNORE_INDEX = -100
EOS_TEXT = "<|endoftext|>"
EOT_TEXT = "<|eot_id|>"
PAD_TEXT = "<|finetune_right_pad_id|>"
GPT2_VOCAB_SIZE = 50257

# Chat markup (public Llama-3 header token names).
BOS_TEXT = "<|begin_of_text|>"
HEADER_START_TEXT = "<|start_header_id|>"
HEADER_END_TEXT = "<|end_header_id|>"

# Word tokenizer: a run of letters/marks, a run of digits, or one other non-space
# character. Tokens never contain whitespace, so text may be split at whitespace
# without changing the tokens. Works unchanged in Java regex and RE2 (DuckDB).
WORD_PATTERN = r"[\p{L}\p{M}]+|\p{N}+|[^\s\p{L}\p{M}\p{N}]"

# Byte tokenizer: ids 0-255 are UTF-8 bytes, specials follow.
BYTE_VOCAB = 256

# Python str.splitlines() boundaries: \r\n first, then any single separator.
SPLITLINES_PATTERN = "\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"

# Characters that Python str.strip() removes, as the inside of a character class that Java's
# regex engine and RE2 both read.
BLANK_CLASS = (r"\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}"
               r"\x{202f}\x{205f}\x{3000}")

# Heading rule of the line corpus: " = Title = " opens a document, " = = Sub = = " does not.
HEADING_PREFIX = " = "
SUBHEADING_PREFIX = " = = "
