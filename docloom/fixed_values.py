"""Formats, defaults and messages that results have to carry exactly."""

# Retrieval and chunking defaults.
TOP_K = 3
INITIAL_K = 10
TOP_K_PER_MODALITY = 4
FINAL_CONTEXT_K = 7
CHUNK_SIZE = 500
CHUNK_OVERLAP = 50
LONG_CHUNK_SIZE = 1200
LONG_CHUNK_OVERLAP = 150
SEPARATORS = ["\n\n", "\n", ". ", " ", ""]
ROWS_PER_CHUNK = 20
ROW_OVERLAP = 3
MISSING_SCORE = 1e9
MODALITY_ORDER = ["text", "table", "image_vlm"]
MAX_SEQUENCE = 128
MAX_DRAFTS = 3

# File types.
EXTRACTABLE_SUFFIXES = [".pdf", ".docx", ".pptx", ".html", ".htm", ".md"]
IMAGE_MIME = {
    ".png": "image/png",
    ".jpg": "image/jpeg",
    ".jpeg": "image/jpeg",
    ".webp": "image/webp",
}
LAYOUTS = {
    "tables": "*/tables/*.csv",
    "text": "*/text/*.docx",
    "images": "*/images/*.{png,jpg,jpeg,webp}",
}

# Joiners and markers.
CONTEXT_JOINER = "\n\n---\n\n"
SOURCE_JOINER = " | "
BLOCK_JOINER = "\n\n"
DUMP_RULE = "-" * 80
CONTROL_WORDS = ["exit", "quit"]
PASS_MARKERS = ["FINAL_SCORE: 8", "FINAL_SCORE: 9", "FINAL_SCORE: 10"]
RUBRIC_MEAN = 7.5
RUBRIC_FLOOR = 6.0

# Sentences a grounded answer falls back to.
FALLBACK_BASIC = "I don't know based on the provided context."
FALLBACK_EVAL = "I don't have enough information in the provided documents."

# Prompts; {context} and {question} are filled in.
PROMPTS = {
    "context_first": (
        "\nAnswer the question using ONLY the context below.\n"
        "If the context does not contain the answer, say:\n"
        f'"{FALLBACK_BASIC}"\n\n'
        "Context:\n{context}\n\nQuestion:\n{question}\n\nAnswer:\n"
    ),
    "question_first": (
        "\nAnswer the question using ONLY the context below.\n"
        f'If the answer is not in the context, say: "{FALLBACK_EVAL}"\n\n'
        "Question:\n{question}\n\nContext:\n{context}\n\nAnswer:\n"
    ),
    "cited": (
        "You are answering using multimodal company knowledge.\n\n"
        "Context (mixed text, tables, OCR, diagrams):\n{context}\n\n"
        "Question: {question}\n\nAnswer clearly and cite sources by [index]."
    ),
    "plain": "{question}",
}

# Headers of contexts, rendered chunks, dumps and table chunks.
CONTEXT_HEADERS = {
    "numbered": "[Context {rank}]",
    "source": "[Source: {source}]",
    "index": (
        "[{rank}] chunk_id={chunk_id} | modality={modality} | doc_id={doc_id} | source={hint} | "
        "score={score} | rerank={rerank}"
    ),
}
CHUNK_HEADER = "chunk_id={chunk_id} | modality={modality} | doc_id={doc_id} | score={score}"
DUMP_HEADER = "[{rank}] source={source} | faiss_distance={distance} | rerank={rerank}"
TABLE_HEADER = (
    "TABLE CHUNK\ndoc_id: {doc_id}\ntable_id: {table_id}\nrows: {first}..{last} (total_rows={total})\n"
    "columns: {columns}\n---\n"
)

# Discount answers.
DISCOUNT_RESULT = "Final price after {percent}% discount is {price}"
DISCOUNT_ERROR = "Invalid input. Use 'price,discount'. Error: {reason}"
DISCOUNT_FEW = "not enough values to unpack (expected 2, got 1)"
DISCOUNT_MANY = "too many values to unpack (expected 2)"
DISCOUNT_WORD = "could not convert string to float: '{value}'"

# Cost notes and unit costs per 1000 tokens (input, output); None = not configured.
NOTE_NO_TOKENS = "Token counts not available from this call path."
NOTE_NO_RATE = {
    "chat": "Chat costs not configured.",
    "embeddings": "Embedding costs not configured.",
    "vlm": "VLM costs not configured.",
}
UNIT_COSTS = {
    "chat": (0.001, 0.001),
    "embeddings": (0.0001, None),
    "vlm": (0.005, 0.005),
}

# Rubric dimensions as they appear in evaluation text.
RUBRIC_DIMENSIONS = ["Relevance", "Clarity", "Completeness", "Feasibility"]
