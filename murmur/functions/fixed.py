"""Fixed values. They decide results, so they are stated plainly here."""

# Stop words left out by word tokenisation.
STOP_WORDS = [
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "has", "he", "in",
    "is", "it", "its", "of", "on", "that", "the", "to", "was", "were", "will", "with",
]

# Topic keywords counted in texts.
AI_KEYWORDS = [
    "artificial", "intelligence", "machine", "learning", "deep", "neural",
    "networks", "natural", "language", "processing", "reinforcement", "ethics",
    "alignment", "chatgpt", "gpt", "bert", "llama", "stable", "diffusion",
    "midjourney", "openai", "google", "deepmind", "anthropic", "source",
    "safety", "regulation", "prompt", "engineering", "fine-tuning",
    "transformers", "gans", "automl", "large", "models", "tensorflow",
    "pytorch", "scikit-learn", "hugging", "face", "langchain", "onnx",
    "cuda", "acceleration", "bias", "privacy", "concerns", "surveillance",
    "autonomous", "weapons", "deepfake", "technology", "gaming", "healthcare",
    "finance", "generative", "applications", "agi", "skynet", "paperclip",
    "maximizer", "doom", "supremacy", "stochastic", "parrot", "sparks",
    "overlords",
    "ai", "ml", "dl", "nlp", "cv", "transformer",
    "dataset", "inference", "supervised", "unsupervised", "optimization",
]

# Phrases that mark a post as being about the topic.
AI_PHRASES = [
    "artificial intelligence",
    "machine learning",
    "neural network",
    "deep learning",
    "ai ",
]

# Authors that are not people.
BOT_AUTHORS = ["AutoModerator", "[deleted]", "None", "null"]

# Communities of each topic.
AI_SUBREDDITS = [
    "artificial", "localLLama", "OpenAI", "MachineLearning",
    "LanguageTechnology", "MLQuestions", "ChatGPT", "singularity",
]
POLITICS_SUBREDDITS = ["politics"]
AI_BOARD = "g"
AI_BOARD_TEXTS = ["artificial intelligence", "AI"]
POLITICS_BOARD = "pol"

# A word: letters, digits and underscore of any script.
WORD_PATTERN = r"[\p{L}\p{N}_]+"

# A plain decimal number.
NUMBER_PATTERN = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"

DAY_NAME_FORMAT = "EEEE"

# Escapes left after decoding, and angle brackets, with what they become, in this order.
LEFT_ESCAPES = [
    ("&gt;", ""), ("&lt;", " "), ("&amp;", "&"), ("&#039;", "'"), ("&quot;", '"'),
    (">", ""), ("<", ""),
]
