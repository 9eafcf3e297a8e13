"""Constants, patterns and formats that results depend on."""

# --- fixed values ---------------------------------------------------------------------------------

# Whitespace as understood by a Unicode-aware split, in the regex dialect of the JVM.
WHITESPACE = r"[\s\x1c-\x1f\x85\p{Z}]+"

# Letters accepted besides a-z by the clean tokenizer.
CZECH_LETTERS = "áčďéěíňóřšťúůýž"

# Punctuation removed from a word before counting.
PUNCTUATION = ".,!?()"

# Words with this prefix are links, not words.
LINK_PREFIX = "http"

# Time offsets a written time may already end with, and the one added when none is there.
KNOWN_OFFSETS = ("+01:00", "+02:00", "+00:00")
DEFAULT_OFFSET = "+01:00"

# Window lengths of the sliding counts.
WORD_WINDOW = ("30 seconds", "15 seconds")
MATCH_WINDOW = ("1 minute", "10 seconds")

# Text pattern counted per window.
MATCH_PATTERN = "% a %"

# Selectors of the article page layout.
ARTICLE_SELECTORS = {
    "title": "h1",
    "opener": ".opener",
    "paragraphs": "#art-text p",
    "tags": "#art-tags > a",
    "photo_count": ".more-gallery b",
    "time": ".art-info .time span.time-date",
    "comment_count": "#moot-linkin span",
}
TIME_ATTRIBUTE = "content"

# Selectors of article links on a listing page; the first is the default.
LINK_SELECTORS = ("[score-type='Article']", "a.art-link", "a.aside")

# Sentence counted when no input is given.
DEFAULT_LINE = "To be, or not to be, that is the question"

# --------------------------------------------------------------------------------------------------

# Fahrenheit scale: the freezing point of water, and its 180 degrees to the boiling point over 100 kelvin.
WATER_FREEZES = 32.0
DEGREES_PER_KELVIN = 180 / 100
