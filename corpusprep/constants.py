"""Fixed values.

Everything in the first block must equal the values the training scripts use, or prepared
examples would differ from theirs. The second block belongs to the built-in codepoint tokenizer.
"""

# --- fixed values (must equal the training scripts' values) ------------------------------------
IGNORE_INDEX = -100                 # label id the loss skips
QUESTION_ID = 195                   # marker before a prompt / human turn
ANSWER_ID = 196                     # marker before an answer / any other turn
QUESTION_TEXT = "<reserved_106>"    # text of the question marker
ANSWER_TEXT = "<reserved_107>"      # text of the answer marker
DEFAULT_PAD_ID = 0                  # pad id when the tokenizer has none
ASSISTANT_MARKER = "\n\nAssistant:"  # end of the prompt inside a preference transcript
HUMAN_ROLE = "human"                # the only `from` value treated as a question in chats
CORPUS_EXTENSIONS = ("txt", "json", "jsonl")
DEFAULT_VALIDATION_PERCENT = 5
DEFAULT_BLOCK_SIZE = 1024
DEFAULT_ROWS_PER_BATCH = 1000       # rows handed to one packing call
DEFAULT_MAX_SOURCE = 2048
DEFAULT_MAX_TARGET = 1024
DEFAULT_PAIR_MAX_LENGTH = 1024      # characters, markers included
SANITY_ROWS_PAIRS = 200
SANITY_ROWS_TRANSCRIPTS = 1000
CHECKPOINT_RING_SIZE = 5
TOKENIZER_LENGTH_WARNING = 4096

# Prompt templates: name, system_prompt, template, roles, sep.
TEMPLATES = [
    ("baichuan-chat", "", " <reserved_102> {query} <reserved_103> ",
     [" <reserved_102> ", " <reserved_103> "], "</s>"),
]

# --- codepoint tokenizer -------------------------------------------------------------------------
CODEPOINT_OFFSET = 256              # id = codepoint + 256; ids below 256 are reserved
EOS_ID = 2
EOS_TEXT = "</s>"
