from verbum.functions.text import (
    doc_id_of,
    doc_text_of,
    is_valid_line,
    label_binary,
    label_signed,
    normalized,
    seeded_uniform,
    words_of,
)

__all__ = [
    "doc_id_of", "doc_text_of", "is_valid_line", "label_binary", "label_signed",
    "normalized", "seeded_uniform", "words_of",
]
