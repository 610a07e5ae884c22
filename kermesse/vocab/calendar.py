"""Calendar words of the Spanish-language sources."""

# Month names and abbreviations -> month number.
MONTHS = {
    "enero": 1, "febrero": 2, "marzo": 3, "abril": 4, "mayo": 5, "junio": 6,
    "julio": 7, "agosto": 8, "septiembre": 9, "setiembre": 9, "octubre": 10,
    "noviembre": 11, "diciembre": 12,
    "ene": 1, "feb": 2, "mar": 3, "abr": 4, "may": 5, "jun": 6, "jul": 7,
    "ago": 8, "sep": 9, "sept": 9, "oct": 10, "nov": 11, "dic": 12,
}

# Folded weekday names, Monday first (index 0 = Monday).
WEEKDAYS = ("lunes", "martes", "miercoles", "jueves", "viernes", "sabado", "domingo")

# Weekday names as displayed.
WEEKDAY_DISPLAY = ("lunes", "martes", "miércoles", "jueves", "viernes", "sábado", "domingo")

# Unambiguous weekday abbreviations -> index.
WEEKDAY_ABBREVIATIONS = {
    "lu": 0, "lun": 0, "ma": 1, "mar": 1, "mi": 2, "mie": 2, "ju": 3, "jue": 3,
    "vi": 4, "vie": 4, "sa": 5, "sab": 5, "do": 6, "dom": 6,
}

# The two-letter codes used inside municipal titles.
TITLE_DAY_CODES = ("lu", "ma", "mi", "ju", "vi", "sa", "do")

# Gap in days still belonging to one season.
MAX_SEASON_GAP_DAYS = 4
