"""Constants the results depend on, kept together as plain text."""

# Characters counted as white space, as a regular-expression class body
# (the Unicode white space set, written so that Java and RE2 read it alike).
WHITE_SPACE = (
    r"\t-\r\x1c- \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)

# Characters a cleaned sentence may hold besides white space.
KEPT = "A-Za-z0-9,."

# Characters that end a sentence; a line break ends one too.
SENTENCE_END = ".!?;"

# Any run of decimal digits is measured with this class.
DIGIT = r"\p{Nd}"

# Default parameters.
MIN_SENTENCE_LENGTH = 20
SYMBOL_THRESHOLD = 0.70
DIGIT_THRESHOLD = 0.70
TRIM_SHARE = 0.01
ALPHA = 0.8
BETA = 0.2
WEIGHT_NEWEST = 1.0
WEIGHT_OLDER = 0.6
FORMS = ("10-K", "10-Q")
ARCHIVE_ROOT = "https://www.sec.gov/Archives/edgar/data"
TOP_THEMES = 10
TOP_EVIDENCE = 20
PAGE_ROWS = 3000
MODEL_BATCH = 128
