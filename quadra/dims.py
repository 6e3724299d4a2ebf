"""Dimension tables and rule catalogues.

FIXED VALUES — these constants must equal the source system's rules for the
results to agree (points of interest, neighbourhood zones, tourist districts,
housing-programme bands, tag patterns, field rules).  They are stated plainly,
in their natural order.  The market fairs lie in ``quadra.fairs``; another set enters
through ``quadra.sources.files.read_fairs`` and ``poi_dim(fairs=...)``.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from quadra.fairs import FAIRS

# ---------------------------------------------------------------------------
# FIXED VALUES: points of interest, category -> [(name, lat, lon)], in order.
# Earlier points win distance ties.
# ---------------------------------------------------------------------------
POIS: dict[str, list[tuple[str, float, float]]] = {
    "praias": [
        ("Leme", -22.9635, -43.1717),
        ("Copacabana (Copacabana Palace)", -22.9700, -43.1830),
        ("Copacabana (Posto 5)", -22.9778, -43.1903),
        ("Ipanema (Posto 9)", -22.9866, -43.2046),
        ("Leblon (Posto 12)", -22.9873, -43.2215),
        ("São Conrado (Pepino)", -22.9975, -43.2647),
        ("Barra (Jardim Oceânico)", -23.0125, -43.3087),
        ("Barra (Posto 4)", -23.0116, -43.3245),
        ("Reserva/Recreio", -23.0182, -43.4332),
        ("Flamengo (Aterro)", -22.9324, -43.1730),
        ("Botafogo (Enseada)", -22.9463, -43.1819),
    ],
    "lazer_verde": [
        ("Lagoa Rodrigo de Freitas", -22.9734, -43.2114),
        ("Aterro do Flamengo", -22.9221, -43.1733),
        ("Jardim Botânico", -22.9676, -43.2233),
        ("Parque Lage", -22.9602, -43.2119),
        ("Quinta da Boa Vista", -22.9056, -43.2244),
        ("Parque Madureira", -22.8732, -43.3402),
        ("Parque Piedade", -22.8929, -43.3080),
        ("Parque Rita Lee", -22.9770, -43.3940),
        ("Parque Realengo", -22.8760, -43.4300),
    ],
    "shoppings_premium": [
        ("Shopping Leblon/Design", -22.9824, -43.2173),
        ("RioSul", -22.9567, -43.1769),
        ("Botafogo Praia", -22.9510, -43.1820),
        ("BarraShopping", -22.9995, -43.3556),
        ("Village Mall", -23.0003, -43.3533),
        ("Shopping Tijuca", -22.9234, -43.2360),
        ("NorteShopping", -22.8879, -43.2831),
        ("Nova América", -22.8794, -43.2721),
    ],
    "transporte_hub": [
        ("Metro Cardeal Arcoverde", -22.9644, -43.1812),
        ("Metro General Osório", -22.9846, -43.1977),
        ("Metro Nossa Sra Paz", -22.9839, -43.2065),
        ("Metro Jardim de Alah", -22.9829, -43.2154),
        ("Metro Antero de Quental", -22.9849, -43.2232),
        ("Metro Botafogo", -22.9510, -43.1840),
        ("Metro Flamengo", -22.9324, -43.1790),
        ("Metro Largo do Machado", -22.9298, -43.1780),
        ("Metro Catete", -22.9267, -43.1775),
        ("Metro Carioca", -22.9079, -43.1772),
        ("Metro Saens Peña", -22.9244, -43.2325),
        ("Metro Uruguai", -22.9317, -43.2405),
        ("Metro São Francisco Xavier", -22.9208, -43.2241),
        ("Metro Jd Oceânico", -23.0076, -43.3106),
        ("Metro São Conrado", -22.9912, -43.2543),
        ("Metro Pavuna", -22.8126, -43.3600),
        ("Metro São Cristóvão", -22.9097, -43.2223),
        ("Estação Central do Brasil", -22.9042, -43.1887),
        ("Estação Méier", -22.9018, -43.2781),
        ("Estação Madureira", -22.8769, -43.3374),
        ("Estação Deodoro", -22.8549, -43.3837),
        ("Estação Bangu", -22.8754, -43.4658),
        ("Estação Campo Grande", -22.9022, -43.5604),
    ],
    "brt_stations": [
        ("Term. Alvorada", -22.9992, -43.3663),
        ("Term. Jardim Oceânico", -23.0076, -43.3106),
        ("Estação Vicente de Carvalho", -22.8546, -43.3134),
        ("Term. Recreio", -23.0139, -43.4533),
        ("Estação Taquara", -22.9213, -43.3725),
        ("Term. Paulo da Portela", -22.8765, -43.3385),
        ("Estação Galeão (Aeroporto)", -22.8079, -43.2530),
    ],
    "saude_educacao": [
        ("Colégio Pedro II (Humaitá)", -22.9569, -43.1936),
        ("Colégio Pedro II (Tijuca)", -22.9189, -43.2183),
        ("Colégio Pedro II (Centro)", -22.9067, -43.2044),
        ("Colégio Pedro II (São Cristóvão)", -22.8997, -43.2217),
        ("Colégio Pedro II (Realengo)", -22.8789, -43.4300),
        ("CAp UFRJ (Lagoa)", -22.9714, -43.2033),
        ("Colégio Militar (Tijuca)", -22.9158, -43.2269),
        ("Santo Inácio", -22.9535, -43.1912),
        ("São Bento", -22.8983, -43.1772),
        ("Hosp. Copa D'Or", -22.9695, -43.1878),
        ("Hosp. Barra D'Or", -22.9942, -43.3637),
        ("Hosp. Souza Aguiar", -22.9077, -43.1908),
        ("Hosp. Miguel Couto", -22.9803, -43.2250),
        ("Hosp. Lourenço Jorge", -22.9992, -43.3663),
        ("INCA (Centro)", -22.9103, -43.1856),
    ],
    "areas_sensiveis": [
        ("Rocinha", -22.9934, -43.2547),
        ("Vidigal", -22.9943, -43.2348),
        ("Cantagalo/Pavão", -22.9763, -43.1952),
        ("Santa Marta", -22.9482, -43.1903),
        ("Tabajaras", -22.9619, -43.1936),
        ("Babilônia/Chapéu", -22.9608, -43.1678),
        ("Complexo do Lins", -22.9189, -43.2798),
        ("Morro dos Macacos", -22.9187, -43.2530),
        ("Salgueiro/Borel", -22.9376, -43.2435),
        ("Turano", -22.9268, -43.2133),
        ("Mangueira", -22.9038, -43.2393),
        ("Jacarezinho", -22.8877, -43.2533),
        ("Complexo do Alemão", -22.8587, -43.2725),
        ("Complexo da Maré", -22.8617, -43.2422),
        ("Complexo da Penha", -22.8468, -43.2829),
        ("Serrinha", -22.8681, -43.3323),
        ("Chapadão", -22.8336, -43.3592),
        ("Cidade de Deus", -22.9489, -43.3622),
        ("Rio das Pedras", -22.9737, -43.3283),
        ("Vila Kennedy", -22.8608, -43.4862),
    ],
    "seguranca_publica": [
        ("2º BPM (Botafogo)", -22.9525, -43.1868),
        ("19º BPM (Copacabana)", -22.9688, -43.1925),
        ("23º BPM (Leblon)", -22.9863, -43.2210),
        ("6º BPM (Tijuca)", -22.9272, -43.2355),
        ("3º BPM (Méier)", -22.9022, -43.2801),
        ("16º BPM (Olaria)", -22.8465, -43.2625),
        ("41º BPM (Irajá)", -22.8358, -43.3370),
        ("9º BPM (Rocha Miranda)", -22.8569, -43.3422),
        ("31º BPM (Barra/Recreio)", -23.0033, -43.3600),
        ("18º BPM (Jacarepaguá)", -22.9300, -43.3522),
    ],
    "mercados_essenciais": [
        ("Mundial (Botafogo)", -22.9497, -43.1865),
        ("Mundial (Copacabana)", -22.9680, -43.1870),
        ("Zona Sul (Ipanema)", -22.9842, -43.1983),
        ("Zona Sul (Leblon)", -22.9860, -43.2250),
        ("Pão de Açúcar (Copacabana)", -22.9682, -43.1855),
        ("Pão de Açúcar (Flamengo)", -22.9360, -43.1765),
        ("Guanabara (Tijuca)", -22.9238, -43.2458),
        ("Mundial (Tijuca)", -22.9254, -43.2343),
        ("Guanabara (Vila Isabel)", -22.9152, -43.2483),
        ("Prezunic (Méier)", -22.8988, -43.2758),
        ("Guanabara (Engenho de Dentro)", -22.8950, -43.2950),
        ("Guanabara (Piedade)", -22.8902, -43.3031),
        ("Mundial (Cachambi)", -22.8880, -43.2750),
        ("Guanabara (Penha)", -22.8400, -43.2800),
        ("Guanabara (Barra)", -23.0062, -43.3389),
        ("Mundial (Jd Oceânico)", -23.0128, -43.3052),
        ("Carrefour (Barra)", -22.9980, -43.3600),
        ("Guanabara (Campo Grande)", -22.9022, -43.5604),
    ],
    "cultura_esporte": [
        ("Aterro do Flamengo (Esportes)", -22.9221, -43.1733),
        ("Ciclovia da Lagoa", -22.9734, -43.2114),
        ("Cidade das Artes (Barra)", -22.9992, -43.3663),
        ("Teatro Municipal", -22.9090, -43.1770),
        ("Imperator (Méier)", -22.8988, -43.2758),
        ("CCBB (Centro)", -22.9015, -43.1765),
        ("Parque Madureira", -22.8732, -43.3402),
    ],
    "pontos_turisticos": [
        ("Cristo Redentor", -22.9519, -43.2105),
        ("Pão de Açúcar", -22.9492, -43.1560),
        ("Escadaria Selarón", -22.9153, -43.1792),
        ("Arcos da Lapa", -22.9133, -43.1803),
        ("Maracanã", -22.9122, -43.2302),
        ("Museu do Amanhã", -22.8946, -43.1797),
        ("Forte de Copacabana", -22.9862, -43.1870),
        ("Santa Teresa", -22.9195, -43.1870),
    ],
}
MAX_FAIRS = 10_000
FAIR_CATEGORY = "feiras_alimentacao"
POIS[FAIR_CATEGORY] = FAIRS

# FIXED VALUES: category -> (distance column, name column) of the geo phase.
GEO_COLUMNS: list[tuple[str, str, str]] = [
    ("praias", "dist_praia_km", "praia_prox"),
    ("lazer_verde", "dist_lazer_km", "lazer_prox"),
    ("shoppings_premium", "dist_shopping_km", "shopping_prox"),
    ("cultura_esporte", "dist_cultura_km", "cultura_prox"),
    ("mercados_essenciais", "dist_mercado_km", "mercado_prox"),
    ("feiras_alimentacao", "dist_feira_km", "feira_prox"),
    ("saude_educacao", "dist_saude_educ_km", "saude_educ_prox"),
    ("areas_sensiveis", "dist_risco_km", "risco_prox"),
    ("seguranca_publica", "dist_policia_km", "policia_prox"),
    ("pontos_turisticos", "dist_turismo_km", "turismo_prox"),
]

# FIXED VALUES: tourist districts (Airbnb vocation).
TOURIST_DISTRICTS = [
    "Copacabana", "Ipanema", "Leblon", "Botafogo", "Flamengo",
    "Leme", "Catete", "Glória", "Laranjeiras", "Humaitá",
    "Jardim Botânico", "Gávea", "São Conrado", "Urca",
    "Santa Teresa", "Lapa", "Centro",
    "Barra Da Tijuca", "Recreio Dos Bandeirantes",
]

# FIXED VALUES: neighbourhood -> zone; zones are tried in this order.
ZONES: list[tuple[str, list[str]]] = [
    ("Zona Sul", [
        "Botafogo", "Catete", "Copacabana", "Cosme Velho", "Flamengo", "Gávea",
        "Humaitá", "Ipanema", "Jardim Botânico", "Lagoa", "Laranjeiras", "Leblon",
        "Leme", "Rocinha", "São Conrado", "Urca", "Vidigal", "Glória",
    ]),
    ("Zona Norte", [
        "Abolição", "Água Santa", "Alto Da Boa Vista", "Andaraí", "Bancários",
        "Benfica", "Bonsucesso", "Brás De Pina", "Cachambi", "Campinho",
        "Cascadura", "Cavalcanti", "Cocotá", "Complexo Do Alemão", "Cordovil",
        "Costa Barros", "Del Castilho", "Encantado", "Engenheiro Leal",
        "Engenho Da Rainha", "Engenho De Dentro", "Engenho Novo", "Estácio",
        "Galeão", "Grajaú", "Guadalupe", "Higienópolis", "Honório Gurgel",
        "Ilha Do Governador", "Inhaúma", "Irajá", "Jardim América",
        "Jardim Carioca", "Jardim Guanabara", "Lins De Vasconcelos",
        "Madureira", "Mangueira", "Manguinhos", "Maracanã", "Maré",
        "Maria Da Graça", "Marechal Hermes", "Méier", "Moneró",
        "Olaria", "Oswaldo Cruz", "Parada De Lucas", "Pavuna", "Penha",
        "Piedade", "Pilares", "Pitangueiras", "Praça Da Bandeira",
        "Praça Seca", "Praia Da Bandeira", "Quintino Bocaiúva", "Ramos",
        "Riachuelo", "Ricardo De Albuquerque", "Rio Comprido", "Rocha",
        "Rocha Miranda", "Sampaio", "São Cristóvão", "São Francisco Xavier",
        "Tauá", "Tijuca", "Todos Os Santos", "Turiaçu", "Vaz Lobo",
        "Vicente De Carvalho", "Vigário Geral", "Vila Da Penha",
        "Vila Isabel", "Vila Kosmos", "Vila Valqueire", "Vista Alegre",
        "Bento Ribeiro", "Cacuia", "Cidade Universitária", "Coelho Neto",
        "Colégio", "Freguesia (Ilha)", "Portuguesa",
        "Ribeira", "Zumbi", "Acari", "Anchieta", "Barros Filho",
        "Caju", "Catumbi", "Cidade Nova", "Saúde",
    ]),
    ("Zona Oeste", [
        "Anil", "Barra Da Tijuca", "Barra Olímpica", "Bangu", "Campo Grande",
        "Campo Dos Afonsos", "Camorim", "Cidade De Deus", "Cosmos",
        "Curicica", "Deodoro", "Freguesia (Jacarepaguá)", "Gardênia Azul",
        "Grumari", "Guaratiba", "Inhoaíba", "Itanhangá", "Jacarepaguá",
        "Jardim Sulacap", "Joá", "Magalhães Bastos", "Padre Miguel",
        "Paciência", "Pechincha", "Pedra De Guaratiba", "Praça Seca",
        "Realengo", "Recreio Dos Bandeirantes", "Rio Das Pedras",
        "Santa Cruz", "Santíssimo", "Senador Camará", "Senador Vasconcelos",
        "Sepetiba", "Tanque", "Taquara", "Vargem Grande", "Vargem Pequena",
        "Vila Kennedy", "Vila Militar",
    ]),
    ("Centro", [
        "Centro", "Gamboa", "Lapa", "Paquetá", "Santa Teresa", "Santo Cristo",
    ]),
]
ZONE_UNKNOWN = "Não classificado"

# FIXED VALUES: Portuguese month names.
MONTHS_PT = [
    ("janeiro", 1), ("fevereiro", 2), ("março", 3), ("abril", 4), ("maio", 5), ("junho", 6),
    ("julho", 7), ("agosto", 8), ("setembro", 9), ("outubro", 10), ("novembro", 11), ("dezembro", 12),
]

# FIXED VALUES: housing-programme bands (band, property ceiling, max subsidy,
# subsidy factor, yearly rate, financed share, months, has subsidy).
MCMV_BANDS = [
    (1, 264_000.0, 55_000.0, 0.50, 0.0500, 0.95, 420, True),
    (2, 264_000.0, 55_000.0, 0.30, 0.0700, 0.80, 420, True),
    (3, 350_000.0, 0.0, 0.30, 0.0816, 0.80, 420, False),
    (4, 500_000.0, 0.0, 0.30, 0.1050, 0.80, 420, False),
]
MCMV_LABELS = {0: "Não elegível", 1: "Faixa 1", 2: "Faixa 2", 3: "Faixa 3", 4: "Faixa 4"}
# FIXED VALUES: market financing (ceiling, yearly rate, financed share, months).
SFH = (2_250_000.0, 0.1099, 0.80, 420)
SFI = (999_999_999.0, 0.1250, 0.70, 360)
ITBI_RATE = 0.03
REGISTRY_RATE = 0.015
RENT_YIELD = 0.0045

# FIXED VALUES: street abbreviations of the city's address files.
STREET_TYPES = {
    "RUA": "Rua", "RUAS": "Rua",
    "AV": "Avenida", "AVN": "Avenida", "AVENIDA": "Avenida",
    "PCA": "Praça", "PRC": "Praça", "PRÇ": "Praça", "PRA": "Praça",
    "PRACA": "Praça", "PRAÇA": "Praça",
    "ETR": "Estrada", "ESTR": "Estrada", "ESTRADA": "Estrada",
    "VDT": "Viaduto", "VIADUTO": "Viaduto",
    "TVS": "Travessa", "TRAV": "Travessa", "TRAVESSA": "Travessa",
    "LGO": "Largo", "LARGO": "Largo",
    "BEC": "Beco", "BECO": "Beco",
    "ROD": "Rodovia", "RODOVIA": "Rodovia",
    "ALM": "Alameda", "ALAMEDA": "Alameda",
}

# FIXED VALUES: unit and condominium amenity flags -> page item code.
UNIT_AMENITIES = [
    ("aceita_pet", "PETS_ALLOWED"), ("tem_vista_pro_mar", "SEA_VIEW"),
    ("tem_janela_grande", "LARGE_WINDOW"), ("tem_ar_condicionado", "AIR_CONDITIONING"),
    ("tem_banheira", "BATHTUB"), ("tem_banheiro_servico", "SERVICE_BATHROOM"),
    ("tem_armario_cozinha", "KITCHEN_CABINETS"), ("tem_armario_banheiro", "BATHROOM_CABINETS"),
    ("tem_piso_madeira", "WOOD_FLOOR"), ("tem_box_blindex", "BLINDEX_BOX"),
    ("tem_area_servico", "SERVICE_AREA"), ("tem_closet", "CLOSET"), ("tem_copa", "COPA"),
    ("tem_varanda", "BALCONY"), ("tem_varanda_gourmet", "GOURMET_BALCONY"),
]
CONDO_AMENITIES = [
    ("tem_portaria_24h", "CONCIERGE_24H"), ("tem_armario_embutido", "BUILTIN_WARDROBE"),
    ("tem_estacionamento", "PARKING"), ("tem_academia", "GYM"), ("tem_salao_festas", "PARTY_HALL"),
    ("tem_piscina", "POOL"), ("tem_interfone", "INTERCOM"), ("tem_sala_massagem", "MASSAGE_ROOM"),
    ("tem_churrasqueira", "BARBECUE_GRILL"), ("tem_quadra_poliesportiva", "SPORTS_COURT"),
    ("tem_sauna", "SAUNA"), ("tem_playground", "PLAYGROUND"), ("tem_squash", "SQUASH"),
    ("tem_condominio_fechado", "GATED_COMMUNITY"), ("tem_elevador", "ELEVATOR"),
    ("tem_loja", "STORES"), ("tem_administracao", "ADMINISTRATION"), ("tem_zelador", "CARETAKER"),
]

# FIXED VALUES: description tag catalogue, tag -> pattern (lower-cased text, find semantics).
TAGS: list[tuple[str, str]] = [
    ("tag_lamina", r"\bl[aâ]mina\b|prédio l[aâ]mina|edif[ií]cio l[aâ]mina"),
    ("tag_cobertura_linear", r"cobertura linear|linear com terra[çc]o|cobertura duplex"),
    ("tag_pe_direito_alto", r"p[eé] direito alto|pé-direito|p[eé] direito duplo|p[eé] direito elevado|"
                            r"p[eé].direito alto|pé direito de \d"),
    ("tag_janelao", r"janel[aã]o|janelas amplas|janelas grandes|esquadrias de alumínio|"
                    r"janelas do ch[aã]o ao teto"),
    ("tag_indevassavel", r"indevass[aá]vel|vista livre|vista desimpedida|vista permanente|"
                         r"sem vis-[aà]-vis|vista definitiva"),
    ("tag_vista_cristo", r"vista.*(?:cristo|redentor|corcovado)|(?:cristo|corcovado).*vista"),
    ("tag_vista_pao_acucar", r"vista.*(?:p[aã]o de a[cç][uú]car|enseada)|p[aã]o de a[cç][uú]car.*vista"),
    ("tag_vista_mar", r"vista.*(?:mar|oceano|praia)|frente.?mar|de frente (?:para|pro|pra) (?:o )?mar|"
                      r"vista para (?:a )?praia"),
    ("tag_sol_passante", r"sol passante|ventila[cç][aã]o cruzada"),
    ("tag_sol_manha", r"sol (?:da|pela|de) manh[ãa]|nascente|face norte|face leste"),
    ("tag_reformado", r"reformado|reforma completa|totalmente reformado|reforma recente|"
                      r"rec[eé]m.reformado|reformado por arquiteto|projeto de ilumina[cç][aã]o|"
                      r"fino acabamento|acabamento de primeira|alto padr[aã]o de acabamento|"
                      r"reforma total|todo reformado|recem reformado"),
    ("tag_precisa_reforma", r"estado original|precisa de (?:obra|reforma|moderniza)|para reformar|"
                            r"necessita reforma|bom para reformar|oportunidade.{0,20}reform"),
    ("tag_retrofit", r"retrofit|toda hidr[aá]ulica e el[eé]trica nova|hidr[aá]ulica nova|"
                     r"instala[cç][oõ]es novas|rede el[eé]trica nova"),
    ("tag_novo_nunca_habitado", r"nunca habitado|nunca morou|primeira loca[cç][aã]o|primeira moradia|"
                                r"primeira habita[cç][aã]o|zero km|0km|im[oó]vel novo|apartamento novo"),
    ("tag_exclusivo", r"um por andar|1 por andar|[uú]nico por andar|hall privativo|"
                      r"elevador privativo|andar inteiro|unidade [uú]nica|exclusivo"),
    ("tag_centro_terreno", r"centro de terreno|afastado da rua|recuado|no centro do terreno"),
    ("tag_silencioso", r"silencioso|silêncio|rua tranquila|rua calma|local tranquilo|"
                       r"tranquilidade|sem barulho"),
    ("tag_arborizada", r"arborizada|rua arborizada|rodeado de verde|muito verde|"
                       r"[aá]rvores|cercado.{0,10}natureza"),
    ("tag_vazio", r"vazio|chaves em m[aã]os|entrega imediata|desocupado|pronto para morar|"
                  r"mude j[aá]|disponível para mudan[cç]a|chaves na m[aã]o"),
    ("tag_doc_ok", r"documenta[cç][aã]o (?:ok|cristalina|perfeita|em ordem|regular)|"
                   r"aceita financiamento|aceita fgts|escriturado|"
                   r"escritura.{0,15}(?:ok|dia|ordem)"),
    ("tag_aceita_permuta", r"aceita permuta|permuta|troca"),
    ("tag_mobiliado", r"mobiliado|mobília|mobiliad[oa]|m[oó]veis planejados|totalmente mobiliado|"
                      r"semi.mobiliado|parcialmente mobiliado"),
    ("tag_gourmet", r"gourmet|espa[cç]o gourmet|cozinha gourmet|varanda gourmet|"
                    r"[aá]rea gourmet|churrasqueira gourmet"),
    ("tag_coworking", r"coworking|co-working|home.?office|escrit[oó]rio|sala de trabalho"),
    ("tag_sustentavel", r"solar|fotovoltaic|reaproveitamento|sustent[aá]vel|[aá]gua de chuva|"
                        r"ecol[oó]gic|green.?building|leed"),
    ("tag_pet_friendly", r"pet.?friendly|aceita pet|permite animal|pet.?place|brinquedoteca pet|"
                         r"[aá]rea pet|espa[cç]o pet"),
]

# FIXED VALUES: urgency trigger phrases.
URGENCY_PHRASES = [
    "motivo viagem", "mudança", "inventário", "urgente",
    "oportunidade", "abaixo da avaliação", "baixou",
    "oferta", "proposta", "liquidez", "aceito proposta",
    "saída do país", "divórcio", "separação",
]

# FIXED VALUES: comfort-index weights (infra, leisure, text).
COMFORT_WEIGHTS = [
    ("tem_portaria_24h", 10), ("tem_elevador", 10), ("tem_varanda", 8),
    ("tem_ar_condicionado", 5), ("tem_armario_embutido", 2), ("tem_box_blindex", 1),
    ("tem_piscina", 5), ("tem_academia", 4), ("tem_churrasqueira", 3),
    ("tem_salao_festas", 2), ("tem_sauna", 2), ("tem_varanda_gourmet", 5),
    ("tag_sol_manha", 8), ("tag_silencioso", 6), ("tag_indevassavel", 5),
    ("tag_vista_mar", 5), ("tag_reformado", 5), ("tag_vazio", 2),
    ("tag_mobiliado", 3), ("tag_gourmet", 2),
]
COMFORT_PARKING_WEIGHT = 15

# FIXED VALUES: data-quality field rules (field, description, kind, minimum %).
FIELD_RULES = [
    ("valor_R$", "Preço do imóvel", "num", 95),
    ("area_m2", "Área em m²", "num", 95),
    ("condominio_R$", "Valor do condomínio", "num", 50),
    ("iptu_R$", "Valor do IPTU", "num", 30),
    ("quartos", "Número de quartos", "num", 70),
    ("bairro", "Bairro do imóvel", "txt", 95),
    ("rua", "Rua do imóvel", "txt", 80),
    ("descricao", "Descrição do anúncio", "lng", 90),
    ("tipo_imovel", "Tipo (Apartamento, Casa...)", "txt", 90),
    ("status_construcao", "Status (Pronto, Em construção)", "txt", 80),
    ("endereco_completo", "Endereço completo", "txt", 80),
    ("corretora", "Nome da corretora", "txt", 50),
    ("coordenadas", "Coordenadas lat/lon", "geo", 80),
    ("publicacao_texto", "Texto de publicação", "txt", 70),
    ("dias_publicado", "Dias desde publicação", "num", 60),
    ("tem_portaria_24h", "Portaria 24h", "bool", 0),
    ("tem_elevador", "Elevador", "bool", 0),
    ("tem_piscina", "Piscina", "bool", 0),
    ("preco_m2", "Preço por m²", "var", 0),
    ("custo_fixo_mensal", "Custo fixo mensal", "var", 0),
    ("score_conforto", "Score de conforto", "var", 0),
    ("score_investimento", "Score de investimento", "var", 0),
    ("anos_payback", "Payback (anos)", "var", 0),
]
# FIXED VALUES: text values that count as empty in the text rule.
INVALID_TEXT = ["", "nan", "Nan", "None", "Rua Não Informada", "Não Informado", "Indefinido", "0", "0.0"]
# FIXED VALUES: street names that cannot anchor a street reference price.
INVALID_STREETS = ["Rua Não Informada", "Endereço Não Disponível", "Nan", ""]

# FIXED VALUES: quintile labels.
PRICE_SEGMENTS = ["Econômico (Top 20% Baratos)", "Médio-Baixo", "Médio-Alto", "Alto Padrão",
                  "Luxo (Top 20% Caros)"]
SIZE_SEGMENTS = ["Compacto", "Padrão", "Confortável", "Espaçoso", "Gigante"]


POI_SCHEMA = T.StructType([
    T.StructField("category", T.StringType(), False),
    T.StructField("ord", T.IntegerType(), False),
    T.StructField("name", T.StringType(), False),
    T.StructField("lat", T.DoubleType(), False),
    T.StructField("lon", T.DoubleType(), False),
])


def poi_rows(categories: dict[str, list[tuple[str, float, float]]] | None = None):
    cats = POIS if categories is None else categories
    return [(c, i, n, float(la), float(lo)) for c, pts in cats.items() for i, (n, la, lo) in enumerate(pts)]


def poi_dim(spark: SparkSession, fairs: DataFrame | None = None) -> DataFrame:
    """``poi(category, ord, name, lat, lon)``; with ``fairs`` (name, lat, lon, at most ``MAX_FAIRS``) in place of the fixed ones."""
    rows = poi_rows()
    if fairs is not None:
        found = fairs.select("name", "lat", "lon").orderBy("name").limit(MAX_FAIRS + 1).collect()
        if len(found) > MAX_FAIRS:
            raise ValueError(f"more than {MAX_FAIRS} fairs")
        rows = [r for r in rows if r[0] != FAIR_CATEGORY] + [(FAIR_CATEGORY, i, r["name"], float(r["lat"]), float(r["lon"])) for i, r in enumerate(found)]
    return spark.createDataFrame(rows, POI_SCHEMA)


def zone_rows():
    """(bairro, bairro_norm, zona, prio) — prio is the zone's test order."""
    from quadra.functions.text import strip_accents_py
    return [(b, strip_accents_py(b).lower(), z, p) for p, (z, names) in enumerate(ZONES) for b in names]
