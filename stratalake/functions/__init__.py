from .text import academic_year, code_prefix, display_title, spreadsheet_code
from .values import blank_tokens, clean_cast, is_token, ratio, round_places

__all__ = [
    "academic_year",
    "blank_tokens",
    "clean_cast",
    "code_prefix",
    "display_title",
    "is_token",
    "ratio",
    "round_places",
    "spreadsheet_code",
]
