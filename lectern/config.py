"""Tunable parameters with the reference's defaults.

Fixed values that must equal the reference's for equal results.
"""

# Chunking: characters per chunk and characters shared by neighbours.
CHUNK_SIZE = 800
CHUNK_OVERLAP = 160

# Vector encoding.
EMBEDDING_DIMENSION = 384

# Quote search.
RETRIEVAL_CANDIDATES = 50      # shortlist size per query
RERANK_MAX_WINDOWS = 200       # windows scored per query
DEFAULT_RESULT_LIMIT = 5       # hits per query
MAX_WINDOW_SENTENCES = 3
IVFFLAT_PROBES = 32
IVFFLAT_LISTS = 1000

# Tone.
TONE_WINDOW_TOKENS = 384
TONE_LABELS = ("academic", "militant", "hopeful", "critical")

# Topics.
TOPIC_NGRAM_RANGE = (1, 3)
TOPIC_MIN_DF = 10
TOPIC_MIN_CLUSTER_SIZE = 50
TOPIC_PCA_COMPONENTS = 50
TOPIC_TOP_TERMS = 10
OUTLIER_TOPIC_ID = -1

# Listing bounds.
DEFAULT_ARTICLE_LIMIT = 50
MAX_ARTICLE_LIMIT = 200
DEFAULT_TOPIC_LIMIT = 50
MAX_TOPIC_LIMIT = 200
MAX_QUOTE_LIMIT = 50
MAX_QUERY_CHARS = 512

# Largest side we broadcast without a second look (bytes).
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024
