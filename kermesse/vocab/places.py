"""Areas, regions, venues and street spelling of the metropolitan region."""

# Areas detected in free text; list order decides among several.
DETECTED_AREAS = (
    "Santiago", "Providencia", "Las Condes", "Vitacura", "Lo Barnechea", "Ñuñoa",
    "La Reina", "Macul", "Peñalolén", "La Florida", "Puente Alto", "San Joaquín",
    "San Miguel", "La Cisterna", "El Bosque", "La Granja", "Maipú", "Estación Central",
    "Quinta Normal", "Cerrillos", "Pudahuel", "Renca", "Quilicura", "Conchalí",
    "Huechuraba", "Recoleta", "Independencia", "Cerro Navia", "Lo Prado",
    "Pedro Aguirre Cerda", "Lo Espejo", "San Ramón", "La Pintana", "San Bernardo",
)

# Area centre points, in lookup order.
AREA_CENTRES = {
    "Santiago": (-33.4425, -70.6505),
    "Providencia": (-33.4256, -70.6096),
    "Las Condes": (-33.4088, -70.5673),
    "Vitacura": (-33.3899, -70.5817),
    "Lo Barnechea": (-33.3512, -70.5180),
    "Ñuñoa": (-33.4569, -70.5975),
    "La Reina": (-33.4437, -70.5405),
    "Macul": (-33.4890, -70.5980),
    "Peñalolén": (-33.4849, -70.5423),
    "La Florida": (-33.5225, -70.5990),
    "Estación Central": (-33.4610, -70.6790),
    "Quinta Normal": (-33.4400, -70.7000),
    "Recoleta": (-33.4100, -70.6400),
    "Independencia": (-33.4150, -70.6650),
    "San Miguel": (-33.4960, -70.6520),
    "Maipú": (-33.5110, -70.7580),
    "La Granja": (-33.5400, -70.6250),
    "San Joaquín": (-33.4950, -70.6270),
    "Puente Alto": (-33.6110, -70.5760),
    "Huechuraba": (-33.3706, -70.6408),
    "Conchalí": (-33.3830, -70.6750),
    "Renca": (-33.4040, -70.7290),
    "Quilicura": (-33.3670, -70.7290),
    "Cerro Navia": (-33.4230, -70.7400),
    "Lo Prado": (-33.4450, -70.7250),
    "Pudahuel": (-33.4406, -70.7530),
    "Cerrillos": (-33.4967, -70.7161),
    "Pedro Aguirre Cerda": (-33.4870, -70.6720),
    "Lo Espejo": (-33.5230, -70.6890),
    "San Ramón": (-33.5390, -70.6440),
    "La Cisterna": (-33.5378, -70.6636),
    "El Bosque": (-33.5620, -70.6750),
    "La Pintana": (-33.5830, -70.6330),
    "San Bernardo": (-33.5921, -70.6994),
    "Colina": (-33.2019, -70.6747),
    "Lampa": (-33.2833, -70.8778),
    "Til Til": (-33.0870, -70.9280),
    "Buin": (-33.7333, -70.7417),
    "Paine": (-33.8083, -70.7411),
    "Pirque": (-33.6403, -70.5544),
    "San José de Maipo": (-33.6400, -70.3520),
    "Talagante": (-33.6640, -70.9280),
    "Peñaflor": (-33.6090, -70.8770),
    "Padre Hurtado": (-33.5730, -70.8130),
    "El Monte": (-33.6790, -71.0130),
    "Isla de Maipo": (-33.7500, -70.8990),
    "Curacaví": (-33.4033, -71.1447),
    "Melipilla": (-33.6880, -71.2150),
    "Calera de Tango": (-33.6280, -70.7810),
}

# Venues with a verified point, in lookup order.
KNOWN_VENUES = {
    "gam": (-33.4372, -70.6403),
    "centro cultural gabriela mistral": (-33.4372, -70.6403),
    "matucana 100": (-33.4436, -70.6836),
    "m100": (-33.4436, -70.6836),
    "ceina": (-33.4453, -70.6502),
    "centro cultural la moneda": (-33.4429, -70.6539),
    "cclm": (-33.4429, -70.6539),
    "teatro municipal de santiago": (-33.4407, -70.6480),
    "teatro municipal": (-33.4407, -70.6480),
    "teatro uc": (-33.4372, -70.6222),
    "museo nacional de bellas artes": (-33.4353, -70.6437),
    "mavi": (-33.4383, -70.6403),
    "museo de artes visuales": (-33.4383, -70.6403),
    "museo de la memoria": (-33.4372, -70.6790),
    "planetario usach": (-33.4490, -70.6850),
    "parque metropolitano": (-33.4270, -70.6320),
    "parquemet": (-33.4270, -70.6320),
    "cerro san cristobal": (-33.4258, -70.6320),
    "balmaceda arte joven": (-33.4330, -70.6800),
    "nave": (-33.4390, -70.6690),
    "universidad diego portales": (-33.4460, -70.6520),
    "udp": (-33.4460, -70.6520),
    "biblioteca de santiago": (-33.4400, -70.6830),
    "biblioteca nacional": (-33.44206, -70.64792),
    "estadio nacional": (-33.4644, -70.6106),
    "movistar arena": (-33.46271, -70.66177),
    "teatro caupolican": (-33.4560, -70.6540),
    "club chocolate": (-33.4330, -70.6350),
    "blondie": (-33.4492, -70.6738),
    "corporacion cultural de vitacura": (-33.3899, -70.5817),
    "centro artesanal los dominicos": (-33.4030, -70.5350),
}

# Street spelling -> catalogue spelling, token by token.
STREET_TOKENS = {
    "av": "avenida", "avda": "avenida", "gral": "general", "pje": "pasaje",
    "sta": "santa", "sto": "santo", "pdte": "presidente",
    "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6",
    "siete": "7", "ocho": "8", "nueve": "9", "diez": "10", "once": "11", "doce": "12",
    "trece": "13", "catorce": "14", "quince": "15", "dieciseis": "16",
    "diecisiete": "17", "dieciocho": "18", "diecinueve": "19", "veinte": "20",
    "veintiuno": "21",
}

# Kilometres per degree at this latitude.
KM_PER_DEGREE_LAT = 111.0
KM_PER_DEGREE_LON = 92.0

# The boxes in use, as (lat_min, lat_max, lon_min, lon_max).
BOX_REGION = (-34.05, -33.00, -71.30, -70.30)
BOX_CATALOGUE = (-34.30, -32.90, -71.80, -70.00)
BOX_CITY_PAGE = (-33.75, -33.20, -70.95, -70.35)

# Programme names that sources put where a venue belongs.
PROGRAMME_NAMES = (
    "deporte vecinal", "futbol", "escuelas abiertas", "academias deportivas",
    "personas mayores", "actividad fisica y salud", "talleres deportivos", "deportes",
)

# Place names that are aggregators or programmes, not places.
NOT_A_PLACE = (
    r"portaltickets|portaldisc|passline|puntoticket|ticketmaster|toliv"
    r"|red salas de teatro|deporte vecinal|escuelas abiertas"
    r"|academias deportivas|personas mayores|disfruta santiago"
    r"|^online$|^futbol$|^fútbol$|agregador|por confirmar|a confirmar"
)

# Precision labels, and those that count as an exact pin.
PRECISIONS = ("recinto", "fuente", "calle", "comuna", "correccion", "sin_ubicar", "")
EXACT_PRECISIONS = ("recinto", "fuente", "calle", "correccion")

# Map tags that make a named object a place, by key order.
PLACE_TAGS = {
    "amenity": ("bar", "pub", "nightclub", "cafe", "restaurant", "fast_food", "theatre",
                "cinema", "arts_centre", "community_centre", "events_venue",
                "music_venue", "planetarium", "library"),
    "leisure": ("sports_centre", "stadium", "fitness_centre", "swimming_pool", "pitch",
                "sports_hall", "dance"),
    "tourism": ("museum", "gallery", "attraction"),
}
FOOD_PLACE_TYPES = ("restaurant", "fast_food", "cafe", "bar", "pub")
GENERIC_MERCHANTS = ("bar", "cafe", "restaurant", "restaurante", "pub", "sushi", "pizza",
                     "buffet", "food", "market", "express", "delivery")

# Regions of the country, folded spelling -> canonical name.
REGIONS = {
    "arica y parinacota": "Arica y Parinacota", "tarapaca": "Tarapacá",
    "antofagasta": "Antofagasta", "atacama": "Atacama", "coquimbo": "Coquimbo",
    "valparaiso": "Valparaíso", "metropolitana de santiago": "Metropolitana",
    "metropolitana": "Metropolitana", "ohiggins": "O'Higgins", "o higgins": "O'Higgins",
    "libertador general bernardo ohiggins": "O'Higgins", "maule": "Maule",
    "nuble": "Ñuble", "biobio": "Biobío", "la araucania": "La Araucanía",
    "araucania": "La Araucanía", "los rios": "Los Ríos", "los lagos": "Los Lagos",
    "aysen": "Aysén", "aysen del general carlos ibanez del campo": "Aysén",
    "magallanes": "Magallanes", "magallanes y de la antartica chilena": "Magallanes",
}

# Areas the offer sources name (keys are their folded spelling).
OFFER_AREAS = (
    "Santiago", "Providencia", "Las Condes", "Vitacura", "Lo Barnechea", "Ñuñoa",
    "La Reina", "Macul", "Peñalolén", "La Florida", "Puente Alto", "San Joaquín",
    "San Miguel", "La Cisterna", "El Bosque", "La Granja", "Maipú", "Estación Central",
    "Quinta Normal", "Cerrillos", "Pudahuel", "Renca", "Quilicura", "Conchalí",
    "Huechuraba", "Recoleta", "Independencia", "Cerro Navia", "Lo Prado", "Lo Espejo",
    "Pedro Aguirre Cerda", "San Ramón", "La Pintana", "San Bernardo", "Colina", "Lampa",
    "Buin", "Padre Hurtado", "Pirque", "San José de Maipo", "Talagante", "Melipilla",
    "Peñaflor", "Calera de Tango", "Viña del Mar", "Concón", "Quilpué", "Villa Alemana",
    "San Antonio", "Quintero", "Zapallar", "Papudo", "La Ligua", "Los Andes",
    "San Felipe", "Cachagua", "Algarrobo", "El Quisco", "Cartagena", "Olmué", "Limache",
    "Casablanca", "Arica", "Iquique", "Alto Hospicio", "Calama", "San Pedro de Atacama",
    "Copiapó", "Caldera", "Vallenar", "La Serena", "Ovalle", "Vicuña", "Illapel",
    "Rancagua", "Machalí", "Santa Cruz", "Pichilemu", "San Fernando", "Talca", "Curicó",
    "Linares", "Constitución", "Chillán", "Concepción", "Talcahuano",
    "San Pedro de la Paz", "Chiguayante", "Los Ángeles", "Coronel", "Temuco",
    "Padre Las Casas", "Villarrica", "Pucón", "Valdivia", "Osorno", "Puerto Montt",
    "Puerto Varas", "Frutillar", "Castro", "Ancud", "Chiloé", "Coyhaique",
    "Puerto Natales", "Punta Arenas",
)

# Areas of the metropolitan region for offers.
REGION_AREAS = (
    "Santiago", "Cerrillos", "Cerro Navia", "Conchalí", "El Bosque", "Estación Central",
    "Huechuraba", "Independencia", "La Cisterna", "La Florida", "La Granja",
    "La Pintana", "La Reina", "Las Condes", "Lo Barnechea", "Lo Espejo", "Lo Prado",
    "Macul", "Maipú", "Ñuñoa", "Pedro Aguirre Cerda", "Peñalolén", "Providencia",
    "Pudahuel", "Quilicura", "Quinta Normal", "Recoleta", "Renca", "San Joaquín",
    "San Miguel", "San Ramón", "Vitacura", "Puente Alto", "Pirque", "San José de Maipo",
    "Colina", "Lampa", "Tiltil", "San Bernardo", "Buin", "Calera de Tango", "Paine",
    "Melipilla", "Alhué", "Curacaví", "María Pinto", "San Pedro", "Talagante",
    "El Monte", "Isla de Maipo", "Padre Hurtado", "Peñaflor",
)

# Discovery sectors.
SECTORS = {
    "centro": ("Santiago", "Estación Central", "Recoleta", "Independencia",
               "Quinta Normal", "Cerrillos", "Pedro Aguirre Cerda"),
    "oriente": ("Providencia", "Ñuñoa", "Las Condes", "Vitacura", "Lo Barnechea",
                "La Reina", "Peñalolén", "Macul"),
    "norte": ("Huechuraba", "Conchalí", "Quilicura", "Renca", "Colina", "Lampa",
              "Cerro Navia"),
    "sur": ("La Florida", "Puente Alto", "Maipú", "La Pintana", "San Miguel", "La Granja",
            "El Bosque", "Pudahuel", "San Bernardo", "Lo Espejo", "San Joaquín"),
}

# Cities outside the region that betray a mislabelled area.
OUTSIDE_CITIES = ("talca", "valparaiso", "villarrica", "punta arenas", "la serena",
                  "vicuna", "valdivia")
