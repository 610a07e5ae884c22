"""Vocabulary of the merchant-offer tables."""

# Spellings of a business rubric -> the single vocabulary.
RUBRICS = {
    "restaurantes": "restaurantes", "restaurantes-y-bares": "restaurantes",
    "restaurant": "restaurantes", "comida": "restaurantes",
    "40-de-descuento-visa": "restaurantes", "cafeteria": "cafeterias",
    "cafeterias": "cafeterias", "cafe": "cafeterias", "sabores-gourmet": "gourmet",
    "gourmet-y-delicatessen": "gourmet", "gourmet": "gourmet", "delicatessen": "gourmet",
    "comida-rapida": "comida_rapida", "comida_rapida": "comida_rapida",
    "antojos": "comida_rapida", "fast-food": "comida_rapida",
}

# Merchant-name patterns -> cuisine, first match wins.
CUISINES = (
    ("japonesa", r"\b(sushi\w*|nikkei|ramen|izakaya|teriyaki|yakiniku|sake|tempura|wasabi"
                 r"|sakura|tokyo|osaka|kyoto|niu|maki|donburi|japon\w*|nippon|samurai"
                 r"|katana|hanzo|ichiban|naoki|kaiseki|edo\b|hokkaido|shibuya|ginza|umi\b)\b"),
    ("peruana", r"\b(ceviche|cebiche|cevicheria|peruan\w*|lima|inka|inca|anticucho|causa"
                r"|pisco sour|chifa|astrid|gaston|chalac\w*|limena|barranco|miraflores|machu)\b"),
    ("italiana", r"\b(pizz\w*|pasta|paste|trattoria|ristorante|osteria|napol\w*|italian\w*"
                 r"|gnocchi|risotto|focaccia|lasagna|spaghetti|capric\w*|bella|dolce|vitto"
                 r"|mamma|fagotto|cosenza|capri|toscan\w*|romana|milano|siciliana)\b"),
    ("mexicana", r"\b(taco|tacos|taqueria|mexican\w*|burrito|cantina|guacamole|azteca|maya"
                 r"|jalapeno|nachos|tequila)\b"),
    ("parrilla", r"\b(parrilla|parrillada|grill|asado|steak|steakhouse|carnes|angus|wagyu"
                 r"|brasas|braseria|churrasq\w*)\b"),
    ("mariscos", r"\b(marisco\w*|pescado\w*|ostras|seafood|caleta|pescader\w*|langosta"
                 r"|camaron\w*|congrio|mar\b)\b"),
    ("asiatica", r"\b(wok|china|chino|thai|tailand\w*|asian|asiatic\w*|dim sum|pad thai"
                 r"|korean|coreana|kimchi|bao|noodle\w*|india|hindu|curry|tandoori)\b"),
    ("hamburguesas", r"\b(burger|burgers|hamburgues\w*|wendy\w*|mcdonald\w*|doggis"
                     r"|completo\w*|hot ?dog|streetburger|juicy)\b"),
    ("pollo", r"\b(pollo\w*|chick.?en|kfc|rostiser\w*|alitas|wings)\b"),
    ("vegetariana", r"\b(vegan\w*|vegetarian\w*|veggie|plant based|verde|ensalad\w*|salad)\b"),
    ("panaderia", r"\b(panader\w*|pasteler\w*|bakery|bread|pan\b|masas|kuchen|reposter\w*"
                  r"|dulcer\w*|heladeria|helados|gelato|postres|chocolat\w*|bombon\w*"
                  r"|coppelia|oakberry|acai|mamut|churro\w*|waffle\w*|crepe\w*|donut\w*"
                  r"|dona\w*|frozen|yogur\w*|bozzo|dulce\w*)\b"),
    ("cafe", r"\b(cafe|cafeteria|coffee|espresso|barista|starbucks|juan valdez|tostador\w*"
             r"|te\b|tea|brunch|desayun\w*)\b"),
    ("bar", r"\b(bar\b|pub|cerveceria|brewery|taproom|cocteler\w*|gin\b|whisky|vinoteca"
            r"|wine|bodega|cocktail|vina|vinos|tapas|pisquer\w*)\b"),
    ("chilena", r"\b(chilena|chileno|picada|empanada\w*|cazuela|pastel de choclo|curanto"
                r"|criolla|fuente de soda|schop)\b"),
)

# Names that look like a cuisine and are not, keyed by cuisine.
CUISINE_EXCEPTIONS = {
    "mariscos": r"\b(mar del plata|mar y sol club|bar\s?mar)\b",
    "vegetariana": r"\b(monte verde|valle verde|casa verde)\b",
}

# Cuisine that moves a generic rubric.
RUBRIC_OF_CUISINE = {
    "hamburguesas": "comida_rapida", "comida_rapida": "comida_rapida",
    "pollo": "comida_rapida", "cafe": "cafeterias", "panaderia": "cafeterias",
}

# Tags that are neither an area nor a region.
TAG_NOISE = (
    "segmentado", "casa-matriz", "planes", "big5", "todo-chile", "tarjeta-fan", "sabores",
    "restaurant", "restaurante", "restaurantes", "comida", "sucursale", "sucursales",
    "regiones", "canje-dolares-premios", "dolares-premio",
)

# Patterns over folded offer text.
FOOD = (r"restaurant|restaurante|sabores|gastronom|cafeteria|cafe|bar\b|pizzer|sushi"
        r"|comida|cocina|antojos|brunch|heladeria|pasteler|panaderia")
EVERY_DAY = r"todos los dias|todo los dias|de lunes a domingo|toda la semana"
WEEKEND = r"fin de semana|finde"
IN_PERSON = r"presencial|en el local|en local"
ONLINE = r"online|delivery|en linea|pedidos ya|rappi|uber eats"
GIFT = r"\bgratis\b|\bde regalo\b|\bregalo\b"
COMBO = r"\bcombo|\bpack\b|\bprecio especial|\bprecio fijo"
DANGLING_TITLE = (" - Hasta un", " - Hasta", " – Hasta un", " - hasta un")
DAY_IN_TEXT = (r"(?iu)\b(lunes|martes|mi[eé]rcoles|jueves|viernes|s[áa]bados?|domingos?"
               r"|fin de semana|finde)\b")

# Fetch-failure marks -> explained cause, first contained wins.
FAILURE_CAUSES = (
    ("nodename nor servname", "dns"), ("Name or service not known", "dns"),
    ("Read timed out", "read_timeout"), ("Connection timed out", "connect_timeout"),
    ("Connection refused", "refused"), ("SSLError", "certificate"),
    ("CertificateError", "certificate"), ("robots.txt", "robots"),
)
