"""Signals, companies and situations of the recommendation jobs."""

# Text signals (matched on title and description as written).
CHILD_SIGNAL = (r"(?iu)\b(infantil(es)?|niñ[oa]s?|nino|cuentacuentos|t[ií]teres|marionetas"
                r"|familiar|preescolar|kinder|escolar|guagua|beb[eé]s?|matin[eé]"
                r"|para toda la familia|p[úu]blico familiar)\b")
ADULT_SIGNAL_WORDS = (
    "terror", "horror", "gore", "slasher", "trasnoche", "giallo", "zombis?", "zombies?",
    "malditas?", "posesi[óo]n", "obsesi[óo]n", "thriller", "suspenso", r"psicol[óo]gic\w*",
    r"er[óo]tic\w*", r"sexual\w*", "masacre", r"asesinat\w*", "mayores de 18",
    "solo adultos", "estrictamente adultos", r"18\+", "barra libre", "open bar",
    r"c[óo]ctel\w*", r"coctel\w*", r"cervez\w*", r"cervecer\w*", "vermut", "pisco",
    "whisky", r"mixolog\w*", r"destilad\w*",
)
SPORT_SIGNAL_WORDS = (
    "deporte", r"deportiv\w*", "ejercicio", "entrenamiento", r"entrena\w*", r"gimnasi\w*",
    "running", "trote", "trotar", "maratón", "maraton", "corrida", "atletismo", "caminata",
    "trekking", "senderismo", "cicletada", "ciclismo", "bicicleta", "nataci[óo]n", "nado",
    "yoga", "pilates", "zumba", r"aer[óo]bic\w*", "spinning", "crossfit", "funcional",
    "f[úu]tbol", "futsal", "b[áa]squetbol", "basquetbol", "v[óo]leibol", "voleibol",
    "tenis", "b[áa]dminton", "badminton", "handbol", "hockey", "rugby", "escalada",
    "boxeo", "karate", "taekwondo", "judo", "hapkido", "defensa personal",
    "artes marciales", "baile entretenido", "acondicionamiento", "motricidad", "chikung",
    "tai chi", "taichi", "kayak", "remo", "surf",
)
COUPLE_SIGNAL = (r"(?iu)\b(cena|romantic|rom[áa]ntic|jazz|bolero|tango|vino|degustaci[óo]n"
                 r"|concierto[s]? [íi]ntim|acústic|acustic|serenata|cabaret|clásica|clasica"
                 r"|c[áa]mara|ballet|[óo]pera|opera)\b")
GROUP_SIGNAL = (r"(?iu)\b(fiesta|carrete|tocata|festival|karaoke|torneo|campeonato|pichanga"
                r"|cumbia|reggaet[óo]n|electr[óo]nic|techno|house|dj|banda|rock|metal|punk"
                r"|trivia|juegos|competencia)\b")
TALK_FORMAT = (r"(?iu)\b(webinar|conversatorio|charla|seminario|coloquio|panel|foro"
               r"|conferencia|mesa redonda|clase magistral|masterclass|lanzamiento de libro"
               r"|presentaci[óo]n del libro)\b")
DAY_PATTERN = r"(?i)\b(lu|ma|mi|ju|vi|sa|do)(-(lu|ma|mi|ju|vi|sa|do))+\b"

# What each company adds to a situation.
COMPANIES = {
    "solo": {"weights": {"charla": 4, "arte": 3, "cine": 3, "clases": 3, "fiesta": -2},
             "recurrent": 1},
    "pareja": {"weights": {"teatro": 5, "cine": 5, "musica": 4, "arte": 3, "charla": -2,
                           "clases": -4, "deporte": -4, "familia": -6},
               "recurrent": -9, "hours": (17, 2), "signal": "couple", "signal_bonus": 5,
               "avoid_kids": True},
    "amigos": {"weights": {"fiesta": 6, "musica": 5, "deporte": 3, "feria": 2, "charla": -3,
                           "arte": -2},
               "recurrent": -5, "hours": (16, 3), "signal": "group", "signal_bonus": 4,
               "avoid_kids": True},
    "ninos": {"weights": {"familia": 6, "teatro": 4, "feria": 4, "aire_libre": 4, "cine": 2},
              "hours": (9, 19), "price_ceiling": 15000, "require_kids": True},
}

# Situations and their follow-up answers.
SITUATIONS = {
    "panorama": {"weights": {}, "base": 6, "free_bonus": 4, "variety": True, "one_off": True,
                 "answers": {"seguro": {"weights": {"musica": 4, "teatro": 4, "cine": 3, "feria": 3}},
                             "raro": {"weights": {"otros": 6, "charla": 4, "arte": 3, "musica": -2}}}},
    "musica": {"weights": {"musica": 12, "fiesta": 6}, "hours": (18, 2), "free_bonus": 1,
               "one_off": True,
               "answers": {"suave": {"weights": {"musica": 5, "teatro": 4, "fiesta": -9},
                                     "hours": (17, 23)},
                           "fuerte": {"weights": {"musica": 6, "fiesta": 6}, "hours": (19, 3)}}},
    "escenario": {"weights": {"teatro": 11, "cine": 10, "arte": 9}, "avoid": ("fiesta",),
                  "hours": (11, 23), "free_bonus": 2, "one_off": True,
                  "answers": {"cine": {"weights": {"cine": 8, "teatro": -5, "arte": -3}},
                              "vivo": {"weights": {"teatro": 8, "cine": -6}},
                              "mirar": {"weights": {"arte": 8, "cine": -4, "teatro": -4}}}},
    "noche": {"weights": {"fiesta": 12, "musica": 8}, "hours": (20, 3), "free_bonus": 0,
              "one_off": True, "adults_only": True,
              "answers": {"temprano": {"weights": {"musica": 4, "teatro": 3}, "hours": (19, 23)},
                          "tarde": {"weights": {"fiesta": 6}, "hours": (21, 4)}}},
    "mover": {"weights": {"deporte": 12, "aire_libre": 11, "clases": 5, "familia": 4, "otros": 3},
              "hours": (7, 21), "free_bonus": 3, "sport_signal": True,
              "safe_category": "deporte", "no_talks": True,
              "answers": {"suelto": {"recurrent": -8, "weights": {"aire_libre": 6, "deporte": 3}},
                          "taller": {"recurrent": 6, "weights": {"deporte": 5, "clases": 4}}}},
    "aprender": {"weights": {"charla": 12, "clases": 10, "idiomas": 9, "arte": 3},
                 "hours": (9, 21), "free_bonus": 2,
                 "answers": {"escuchar": {"weights": {"charla": 8, "clases": -5}, "recurrent": -6},
                             "hacer": {"weights": {"clases": 8, "idiomas": 5, "charla": -5},
                                       "recurrent": 4}}},
    "barrio": {"weights": {"feria": 12, "aire_libre": 11, "familia": 4, "musica": 2},
               "hours": (10, 20), "free_bonus": 4, "one_off": True,
               "answers": {"comprar": {"weights": {"feria": 8, "aire_libre": -3}},
                           "pasear": {"weights": {"aire_libre": 8, "familia": 3}}}},
    "comer": {"weights": {}, "answers": {}},
}

# Situations a company rules out.
SITUATION_VETOES = {"ninos": ("noche",)}
