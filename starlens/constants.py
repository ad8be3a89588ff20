"""Names, lists, limits and defaults that decide the results."""

# Sentiment classes in label-code order (code 0, 1, 2).
NEGATIVE, NEUTRAL, POSITIVE = "Negative", "Neutral", "Positive"
SENTIMENTS = (NEGATIVE, NEUTRAL, POSITIVE)
UNKNOWN = "Unknown"
RATINGS = (1, 2, 3, 4, 5)

# Candidate column names, first match wins.
TEXT_COLUMNS = ("reviews.text", "reviewText", "text", "content")
RATING_COLUMNS = ("reviews.rating", "rating", "stars", "overall")
CATEGORY_COLUMNS = ("categories", "category", "product_category")
TITLE_COLUMNS = ("reviews.title", "summary", "title")
LOCAL_TEXT_COLUMNS = ("reviews.text", "review_body", "review_text", "text", "body")
LOCAL_RATING_COLUMNS = ("reviews.rating", "star_rating", "rating", "stars")
FALLBACK_RATING_COLUMNS = ("rating", "star_rating", "score", "stars", "overall")

# Rating given to the labels of a binary data set.
BINARY_RATINGS = {0: 2, 1: 5}

# Substrings of an upper-cased model label that decide its class.
NEGATIVE_MARKS = ("NEGATIVE", "1", "2", "LABEL_0")
NEUTRAL_MARKS = ("NEUTRAL", "3", "LABEL_1")
FAILED_LABEL, FAILED_SCORE = "NEUTRAL", 0.5

# Ids of the special tokens, and the first id of a word.
PAD_ID, UNK_ID, CLS_ID, SEP_ID = 0, 100, 101, 102
FIRST_WORD_ID = 103

# Limits and defaults.
MIN_REVIEW_CHARS = 10
MIN_TOKEN_CHARS = 3
MAX_SCORED_CHARS = 1000
MAX_SEQUENCE = 256
SENTENCE_CHARS = (30, 400)
SUMMARY_SENTENCES = 6
CHUNK_CHARS = 3500
PARTIAL_CHARS = 512
TOP_CATEGORIES = 10
MIN_CATEGORY_REVIEWS = 20
REVIEWS_PER_RATING = 400
SAMPLE_ROWS = 30000
BASELINE_ROWS = 500
VOCABULARY_SIZE = 5000
MIN_DOCUMENTS = 2
MAX_DOCUMENT_SHARE = 0.8
MAX_SENTENCE_SHARE = 0.9
TEST_SHARE = 0.2
NEUTRAL_BOOST = 1.5
NEUTRAL_REBOOST = 1.15
SEED = 42

# Every character that Unicode counts as white space.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0        "
    "        　"
)
# The same set as a class for regular expressions (without the brackets).
SPACE_CLASS = r"\t-\r\x1c- \x85\p{Z}"

# Words that the word tokeniser splits in two.
SPLIT_WORDS = (
    ("can", "not"), ("gim", "me"), ("gon", "na"), ("got", "ta"), ("lem", "me"), ("wan", "na"),
)

# Nouns (and words that look like plurals) that the suffix rules would get wrong.
IRREGULAR_NOUNS = {
    "always": "always", "perhaps": "perhaps", "besides": "besides", "series": "series", "species": "species", "news": "news",
    "lens": "lens", "movies": "movie", "cookies": "cookie", "zombies": "zombie", "calories": "calorie", "ties": "tie", "pies": "pie",
    "lies": "lie", "heroes": "hero", "tomatoes": "tomato", "potatoes": "potato", "echoes": "echo", "shoes": "shoe", "knives": "knife",
    "wives": "wife", "lives": "life", "children": "child", "feet": "foot", "teeth": "tooth", "mice": "mouse", "geese": "goose",
}

# The English stop words that Spark ships (StopWordsRemover).
STOP_WORDS = tuple(
    """
    i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she
    her hers herself it its itself they them their theirs themselves what which who whom this that
    these those am is are was were be been being have has had having do does did doing a an the and
    but if or because as until while of at by for with about against between into through during
    before after above below to from up down in out on off over under again further then once here
    there when where why how all any both each few more most other some such no nor not only own
    same so than too very s t can will just don should now i'll you'll he'll she'll we'll they'll
    i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've you've
    they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't
    shan't shouldn't mustn't can't couldn't cannot could here's how's let's ought that's there's
    what's when's where's who's why's would
    """.split()
)
