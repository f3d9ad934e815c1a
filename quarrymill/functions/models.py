"""What a model's name tells of a car: who tuned it, whether it is made for the track, its family, generation and era."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Makes that are tuners themselves.
TUNER_MAKES = [
    "Alpina", "RUF", "Singer", "Brabus", "Shelby", "Saleen", "Callaway", "Hennessey", "Cupra", "Polestar", "Abarth", "Wiesmann", "W Motors", "Zenvo",
    "Spania GTA", "Bufori", "PGO", "Secma", "Devalliet", "Kimera", "Totem", "TWR", "Gunther Werks", "Eagle", "David Brown", "Lunaz", "Nardone",
    "Theon Design", "Emory", "Twisted", "Gateway Bronco", "Icon 4x4", "Classic Recreations", "Everrati", "Redux", "Prodrive", "Evoluto", "Erreerre",
    "Thornley Kelham", "Kalmar", "Alfaholics", "Ginetta", "Marcos", "Radical", "SCG", "Glickenhaus", "Hopium", "Bizzarrini", "De Tomaso", "Iso",
    "Iso Rivolta", "Bristol", "Jensen", "Jensen-Healey", "Hispano-Suiza", "Cisitalia", "Tucker", "Auburn", "Cord", "Duesenberg", "Stutz", "Pierce-Arrow",
    "Marmon", "Auto Union", "Brabham", "Vanwall", "BRM", "Lola", "Cooper", "Chevron", "Chaparral", "Saab", "Talbot", "Talbot-Lago", "Delahaye", "Delage",
    "Voisin", "Facel Vega", "OSCA", "Panhard", "Salmson", "Hotchkiss", "Bugatti", "TVR", "Reliant", "Daimler", "Plymouth", "Pontiac", "Oldsmobile",
    "Mercury", "Hummer", "Holden", "Rover", "Daewoo", "Edsel", "Hudson", "Studebaker", "LaSalle", "Packard", "Avanti", "Maybach",
]
# Tuners, what shows them, and the makes that this holds for (None: all); the first that fits counts.
TUNERS = [
    ("AMG", r"\bamg\b", ["Mercedes-Benz"]),
    ("M", r"\bM\s?[2-8]\b|\bM[\s-]?(Sport|Perform|Pakket|Pack)\b|\bM-Sport\b", ["BMW"]),
    ("RS", r"\b(RS|RSQ)\d?\b", ["Audi"]),
    ("S", r"\bS\d\b|\bSQ\d\b", ["Audi"]),
    ("JCW", r"\bjcw\b|\b(john\s)?cooper\sworks\b", ["Mini"]),
    ("Nismo", r"\bnismo\b", ["Nissan"]),
    ("STI", r"\bsti\b", ["Subaru"]),
    ("TRD", r"\btrd\b", ["Toyota", "Lexus"]),
    ("SRT", r"\bsrt[0-9]?\b", ["Dodge", "Chrysler", "Jeep", "Ram"]),
    ("N", r"\b(i[23]0\s?N|veloster\s?N|kona\s?N|ioniq\s?5\s?N)\b", ["Hyundai"]),
    ("Renault Sport", r"\b(R\.?S\.?|trophy[\s-]r|megane\s?rs|clio\s?rs)\b|renault sport", ["Renault"]),
    ("Peugeot Sport", r"\b(GTi|PSE)\b|peugeot sport", ["Peugeot"]),
    ("Mopar", r"\bmopar\b", ["Dodge", "Chrysler", "Jeep", "Ram"]),
    ("Ralliart", r"\bralliart\b", ["Mitsubishi"]),
    ("Brabus", r"\bbrabus\b", None),
    ("Mansory", r"\bmansory\b", None),
    ("Liberty Walk", r"\b(liberty[\s-]walk|lbwk|lb[\s-]works?)\b", None),
    ("Rauh-Welt", r"\b(rwb|rauh[\s-]welt)\b", ["Porsche"]),
    ("TechArt", r"\btechart\b", ["Porsche"]),
    ("Gemballa", r"\bgemballa\b", None),
    ("Manthey-Racing", r"\bmanthey\b", ["Porsche"]),
    ("Singer", r"\bsinger\b", ["Porsche"]),
    ("RUF", r"\b(ruf|yellowbird|ctr[0-9]?)\b", ["Porsche"]),
    ("Lorinser", r"\blorinser\b", ["Mercedes-Benz"]),
    ("Carlsson", r"\bcarlsson\b", ["Mercedes-Benz", "Smart"]),
    ("Renntech", r"\brenntech\b", ["Mercedes-Benz"]),
    ("Kleemann", r"\bkleemann\b", ["Mercedes-Benz"]),
    ("Posaidon", r"\bposaidon\b", ["Mercedes-Benz"]),
    ("AC Schnitzer", r"\b(ac.schnitzer|acs)\b", ["BMW", "Mini", "Land Rover"]),
    ("Hamann", r"\bhamann\b", None),
    ("Hartge", r"\bhartge\b", ["BMW", "Mini", "Land Rover"]),
    ("G-Power", r"\bg.power\b", ["BMW"]),
    ("Manhart", r"\bmanhart\b", ["BMW", "Mini", "Porsche"]),
    ("Dinan", r"\bdinan\b", ["BMW"]),
    ("ABT Sportsline", r"\babt\b", ["Audi", "Volkswagen", "SEAT", "Škoda", "Porsche"]),
    ("MTM", r"\bmtm\b", ["Audi", "Volkswagen", "Lamborghini", "Bentley", "Porsche"]),
    ("Novitec", r"\b(novitec|spofec|torado|tridente|rosso)\b", None),
    ("DMC", r"\bdmc\b", ["Lamborghini", "McLaren", "Ferrari"]),
    ("Vorsteiner", r"\bvorsteiner\b", None),
    ("Overfinch", r"\boverfinch\b", ["Land Rover"]),
    ("Kahn Design", r"\b(kahn|project kahn)\b", None),
    ("Startech", r"\bstartech\b", None),
    ("Roush", r"\broush\b", ["Ford"]),
    ("Lingenfelter", r"\blingenfelter\b", None),
    ("Mugen", r"\bmugen\b", ["Honda"]),
    ("Spoon Sports", r"\bspoon\b", ["Honda"]),
    ("HKS", r"\bhks\b", None),
    ("Toms", r"\btoms\b", ["Toyota", "Lexus"]),
    ("Veilside", r"\bveilside\b", None),
    ("Heico Sportiv", r"\bheico\b", ["Volvo"]),
]
# By make, what shows a model made for the track.
TRACK = {
    "Porsche": [r"\bgt[234]\b", r"\bgt3\b", r"\bgt2\b", r"\bgt4\b", r"\bcup\b", r"\b911\s*r\b", "clubsport", r"spyder\s*rs", r"\brs\s*spyder\b"],
    "BMW": [r"\bcsl\b", r"\bm[234]\s*(cs|gts|csl)\b", r"\bm[234]\s*cs\b", r"\bgts\b"],
    "Renault": [r"megane\s*r\.?s", r"clio\s*r\.?s", r"clio\s*cup", "trophy", r"\br\.?s\.?\s*trophy"],
    "Alpine": [r"a110\s*r\b", r"a110\s*s\b", r"a110\s*gt", r"\bcup\b"],
    "Honda": [r"type\s*r\b"],
    "Acura": [r"type\s*r\b"],
    "Lotus": ["elise", "exige", "evora", "emira", "2-?eleven", "3-?eleven", r"\bcup\b"],
    "Caterham": ["seven", r"\b620\b", r"\b420\b", r"\b360\b", r"\b310\b", r"\b485\b"],
    "Ferrari": ["challenge", "scuderia", "speciale", r"\bpista\b", r"\bxx\b", "fxx", r"\bcs\b", "competizione", "stradale"],
    "Lamborghini": ["superleggera", "performante", r"\bsto\b", r"squadra\s*corse", r"super\s*trofeo"],
    "Mercedes-Benz": [r"black\s*series", r"amg\s*gt\s*r\b", r"amg\s*gt\s*black", r"gt\s*r\s*pro"],
    "Mercedes-AMG": [r"black\s*series", r"gt\s*r\b", r"gt\s*black", r"gt\s*r\s*pro"],
    "Audi": [r"r8\s*gt", r"tt\s*rs", r"\brs3\b"],
    "Nissan": ["nismo", r"track\s*edition"],
    "Toyota": [r"\bgr\s", r"gr\s*yaris", r"gr\s*corolla", r"gr\s*supra", "gr86", "gazoo"],
    "McLaren": [r"\d{3}lt\b", r"\b620r\b", "senna", "longtail", r"\bgt3\b", r"\bgt4\b"],
    "Mitsubishi": [r"\bevo\b", "evolution"],
    "Subaru": [r"\bsti\b", r"wrx\s*sti", "22b"],
    "Alfa Romeo": [r"\bgta\b", r"\bgtam\b", "quadrifoglio"],
    "Jaguar": [r"project\s*8", r"\bsvr\b"],
    "Ford": [r"\brs\b", r"mustang\s*r", r"\bgt\b\s*\d{3}", r"shelby\s*gt"],
}
# First years of eras after the first, and what families' names begin with.
ERAS = [(1945, "prewar"), (1990, "classic"), (2005, "youngtimer")]
FAMILIES = {
    "Porsche": r"^(911|718|356|928|924|944|968|914|959|912|930|964|993|996|997|991|992|cayenne|panamera|macan|taycan|boxster|cayman)",
    "Ferrari": r"^(\d{3}|f\d+|testarossa|daytona|enzo|laferrari|roma|portofino|california|mondial|ff|gtc4|monza|sf90|296|12\s*cilindri)",
    "Lamborghini": r"^(countach|diablo|murcielago|aventador|gallardo|huracan|huracán|miura|espada|jarama|urus|urraco|jalpa|reventon|veneno|centenario|sian|revuelto)",
    "BMW": r"^(m[1-8]\b|[1-8]\s*series|[1-8]er|x[1-7]|z[1-8]|i[3-8])",
}
MERCEDES_CLASS, MERCEDES_MODEL = r"^([a-z]+)[\s-]?(?:class|klasse)", r"^(sls|amg\s*gt|sl|slk|slc|clk|cls|cla|gla|glc|gle|gls|glk)"
IN_CAPITALS = ["911", "718", "356", "928", "924", "944", "968", "914", "959", "912"]
GENERATION = [r"\((\d{3}|[ewfg]\d{2,3}|[a-z]\d{2,3})\)", r"\b(e\d{2}|f\d{2}|g\d{2}|w\d{3}|r\d{3})\b"]

# Makes as registers write them, in capitals.
MAKES = ["Audi", "Ferrari", "Porsche", "BMW", "Mercedes-Benz", "Lamborghini", "Maserati", "Aston Martin", "Alfa Romeo", "McLaren", "Nissan", "Toyota", "Honda", "Acura", "Mazda", "Mitsubishi", "Subaru", "Lotus", "Volkswagen"]
# Make, what its models are called, layout and cylinders of their engine; the first that fits counts.
ENGINES = [
    ("Ferrari", r"\b(testarossa|512\s*tr|512\s*m|550|575|599|612|812|f12|812|365|400|412|456|550|575|daytona|550\s*maranello|550\s*barchetta|575\s*m|575m|599\s*gtb|599\s*gto|f12\s*berlinetta|f12tdf|812\s*superfast|812\s*gts|812\s*competizione|12\s*cilindri|12cilindri|fxx|laferrari|enzo|f50|f40|288\s*gto|250|275|330|342|365)", "V12", 12),
    ("Ferrari", r"\b(308|328|348|355|360|430|458|488|296|f8|roma|portofino|california|mondial|gtc4|ff|f355|f430|458\s*italia|488\s*gtb|488\s*pista|f8\s*tributo|sf90|296\s*gtb)", "V8", 8),
    ("Lamborghini", r"\b(countach|diablo|murcielago|aventador|reventon|veneno|centenario|sian|revuelto|miura|espada|jarama|islero|400\s*gt|350\s*gt|lm002|essenza|sesto\s*elemento)", "V12", 12),
    ("Lamborghini", r"\b(gallardo|huracan|huracán)", "V10", 10),
    ("Lamborghini", r"\b(urraco|silhouette|jalpa|urus)", "V8", 8),
    ("Porsche", r"\b(911|912|930|964|993|996|997|991|992|901|carrera\s*gt|959|935|934|906|908|910|718\s*spyder|718\s*cayman\s*gt4|cayman\s*gt4|boxster\s*spyder)", "flat6", 6),
    ("Porsche", r"\b(718|cayman|boxster|914|924|944|968|982)", "flat4", 4),
    ("Porsche", r"\b(cayenne|panamera|macan)", "V6", 6),
    ("Maserati", r"\b(granturismo|gransport|quattroporte|coupe|spyder|3200|4200|gt|shamal|ghibli\s*cup|bora|khamsin|kyalami|mexico)", "V8", 8),
    ("Maserati", r"\b(ghibli|levante|grecale|biturbo|222|228|425|430)", "V6", 6),
    ("Aston Martin", r"\b(db9|db11|dbs|db12|vanquish|virage|one-77|valkyrie|v12\s*vantage|rapide|db7\s*vantage|valour)", "V12", 12),
    ("Aston Martin", r"\b(v8\s*vantage|vantage|db7|dbx|db5|db6|db4|vantage\s*gt)", "V8", 8),
    ("BMW", r"\bm5\b.*\b(e60|e61|v10)\b|\bm6\b.*\b(e63|e64|v10)\b", "V10", 10),
    ("BMW", r"\bm3\b.*\b(e90|e92|e93|v8|s65)\b", "V8", 8),
    ("BMW", r"\b(m1|m2|m3|m4|m5|m6|m8|1m|m\s*coupe|m\s*roadster|z3\s*m|z4\s*m)\b", "L6", 6),
    ("Mercedes-Benz", r"\b(s\s*65|sl\s*65|cl\s*65|g\s*65|s65|sl65|cl65|amg\s*gt\s*black|sls.*black|65\s*amg)", "V12", 12),
    ("Mercedes-Benz", r"\b(c\s*63|e\s*63|s\s*63|cls\s*63|gt\s*63|sl\s*63|g\s*63|ml\s*63|gle\s*63|c63|e63|s63|sls|amg\s*gt|63\s*amg|clk\s*63|clk\s*55|c\s*55|e\s*55|55\s*amg)", "V8", 8),
    ("Alfa Romeo", r"\b(8c|montreal|33\s*stradale|tipo\s*33)", "V8", 8),
    ("Alfa Romeo", r"\b(giulia\s*quadrifoglio|stelvio\s*quadrifoglio|gtv6|164|166|spider\s*v6|gtv\s*v6)", "V6", 6),
    ("Alfa Romeo", r"\b(4c|giulietta|mito|giulia|spider|gtv|brera|159|156|147|gt)", "L4", 4),
    ("McLaren", r"\b(720|650|570|600|620|650s|675|720s|765|artura|gt|540|p1|senna|elva|speedtail|mp4|f1\b)", "V8", 8),
    ("Nissan", r"\b(gt-r|gtr|skyline|r32|r33|r34|r35|350z|370z|z\b|fairlady)", "V6", 6),
    ("Toyota", r"\b(supra|gr\s*supra|2000gt)", "L6", 6),
    ("Toyota", r"\b(gt86|86|gr86|mr2|celica|gr\s*yaris|gr\s*corolla)", "L4", 4),
    ("Honda", r"\b(nsx)", "V6", 6),
    ("Honda", r"\b(s2000|civic\s*type\s*r|integra|type\s*r)", "L4", 4),
    ("Acura", r"\b(nsx)", "V6", 6),
    ("Mazda", r"\b(rx-7|rx7|rx-8|rx8)", "rotary", 2),
    ("Mazda", r"\b(mx-5|miata|mx5)", "L4", 4),
    ("Mitsubishi", r"\b(lancer\s*evo|evo|evolution|3000gt|gto)", "L4", 4),
    ("Subaru", r"\b(impreza|wrx|sti)", "flat4", 4),
]
# What shows a fast model, a special one, one made for races, a limited one; a letter and a number of one make; its fast models.
FAST = r"\b(rs\s?\d?|s[1-8]\b|sq[1-8]|tts|tt\s*rs|gti|gtd|golf\s*r|polo\s*r|\br\b(?!\s*line)|\d{2}\s*amg|amg|quadrifoglio|\bqv\b|abarth|type\s*r|sti|evo|nismo|gt[1-4rs]?|gts|\bcs\b|csl|black\s*series|performante|speciale|scuderia|trofeo|competizione|pista|cup|clubsport|cupra|\bn\b(?!\s)|fiorano|superveloce|sv\b|svj|brabus|alpina|hennessey|mansory|akrapovic|\bturbo\s*s?\b|\bquattro\b)\b"
LETTER_AND_NUMBER = r"\b([a-z]{1,3})\s*(35|43|45|50|53|55|63|65)\b"
SPECIAL = r"\b(rs\d?|gt3|gt2|gt4|gtr|gt-r|sti|evo|evolution|type\s*r|black\s*series|scuderia|speciale|performante|trofeo|stradale|sv\b|svj|superveloce|competizione|pista|tributo|cup|club\s*sport|clubsport|nismo|nurburgring|n\s*ring|track|r-line\s*track|quadrifoglio|qv\b|abarth|brabus|alpina|amg|m\s*sport|s\s*line|gts|gt\s*s|49\s*heritage|spirit\s*70|rocket)\b"
RACING = r"\b(f1|formula\s*1|formula\s*one|f2|f3|gt3|gt2|lmp|lmh|hypercar|le\s*mans|group\s*[abc5]|gr\.\s*[abc5]|dtm|rally\s*car|race\s*car|works|fia\s*gt|homologation|rsr|race-spec|n-gt|gte|imsa|trans-am|nascar|indycar|can-am|tipo\s*33|126\s*c|156\s*f1|248\s*f1|158\s*f1|625\s*f1|312\s*[ptb])\b"
LIMITED = r"\b(limited|numbered|one-77|one\s*off|1\s*of\s*\d|edition|anniversary|jubilee|jubilaum|special\s*edition|\d+\s*exemplaires|collector)\b"
M_MODELS = [r"^M[1-8]\b", r"\bM\d{2,3}[a-z]|\bM\d{2,3}\b|\d{2}\s*M\b"]
# Makes of fast models only; families that are fast, and those that are icons, by make.
FAST_MAKES = ["Ferrari", "Lamborghini", "McLaren", "Pagani", "Koenigsegg", "Bugatti", "Lotus", "Alpine", "Caterham", "Noble", "TVR", "Gumpert", "Wiesmann", "Donkervoort", "Ariel", "Radical", "BAC", "Hennessey", "Saleen", "SSC", "Vector"]
FAST_FAMILIES = {
    "Porsche": ["911", "718", "Cayman", "Boxster", "959", "914", "944", "968", "Carrera GT"],
    "Nissan": ["Skyline GT-R", "Skyline"],
    "Toyota": ["Supra", "GT86", "86", "MR2", "2000GT"],
    "Honda": ["NSX", "S2000", "Integra"],
    "Acura": ["NSX"],
    "Mazda": ["RX-7", "RX-8", "MX-5"],
    "Mitsubishi": ["3000GT", "GTO"],
    "Alfa Romeo": ["4C", "8C", "Montreal"],
    "Lotus": ["Elise", "Exige", "Evora"],
}
ICONS = {
    "Ferrari": ["250", "288", "F40", "F50", "Enzo", "LaFerrari", "Daytona", "Testarossa"],
    "Lamborghini": ["Miura", "Countach"],
    "Porsche": ["Carrera GT", "959", "911"],
    "Mercedes-Benz": ["300 SL"],
    "Jaguar": ["E-Type"],
    "Aston Martin": ["DB5"],
    "McLaren": ["F1"],
    "Bugatti": ["Type 35"],
}

def _first(text: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(text, "(?iu)" + pattern, 1), F.lit(""))


def is_track(make: Column, model: Column) -> Column:
    """Whether one of its make's rules fits a model."""
    low, found = F.lower(F.coalesce(model, F.lit(""))), F.lit(False)
    for name, patterns in TRACK.items():
        found = found | ((make == name) & low.rlike("(?u)(?:" + "|".join(patterns) + ")"))
    return F.coalesce(found, F.lit(False))


def era(first_year: Column) -> Column:
    out = F.when(F.coalesce(first_year, F.lit(0)) == 0, F.lit(None).cast("string"))
    for before, name in ERAS:
        out = out.when(first_year < before, name)
    return out.otherwise("modern")


def family(make: Column, model: Column) -> Column:
    """By what the make's families begin with; else the first word or two of letters and digits."""
    m = F.trim(model)
    capital = lambda x: F.concat(F.upper(F.left(x, F.lit(1))), F.lower(F.substr(x, F.lit(2))))
    told = lambda name: _first(m, FAMILIES[name])
    porsche, klass, mercedes = told("Porsche"), _first(m, MERCEDES_CLASS), _first(m, MERCEDES_MODEL)
    own = (
        F.when((make == "Porsche") & porsche.isNotNull(), F.when(F.lower(porsche).isin(IN_CAPITALS), F.upper(porsche)).otherwise(capital(porsche)))
        .when((make == "Ferrari") & told("Ferrari").isNotNull(), F.upper(told("Ferrari")))
        .when((make == "Lamborghini") & told("Lamborghini").isNotNull(), capital(told("Lamborghini")))
        .when((make == "BMW") & told("BMW").isNotNull(), F.replace(F.upper(told("BMW")), F.lit(" "), F.lit("")))
        .when((make == "Mercedes-Benz") & klass.isNotNull(), F.concat(F.upper(klass), F.lit("-Class")))
        .when((make == "Mercedes-Benz") & mercedes.isNotNull(), F.upper(mercedes))
    )
    return F.coalesce(own, _first(m, r"^([a-z0-9]+(?:[\s-][a-z0-9]+)?)"))


def generation(model: Column) -> Column:
    """A code in brackets, else one that stands by itself."""
    return F.upper(F.coalesce(*[_first(model, p) for p in GENERATION]))


def canonical_make(make: Column) -> Column:
    """A make as its register writes it, whatever its case; others trimmed."""
    tidy = F.trim(F.coalesce(make, F.lit("")))
    names = F.create_map(*[F.lit(x) for name in MAKES for x in (name.upper(), name)])
    return F.coalesce(names[F.upper(tidy)], tidy)


def _shows(text: Column, pattern: str) -> Column:
    return text.rlike("(?i)" + pattern)


def _among(make: Column, family: Column, table: dict[str, list[str]]) -> Column:
    found = F.lit(False)
    for name, families in table.items():
        found = found | ((make == name) & family.isin(families))
    return F.coalesce(found, F.lit(False))


def model_rules(make: Column, model: Column, first_year: Column) -> Column:
    """What rules tell of a model, as a struct: engine_layout, engine_cyl, is_performance, is_special_edition, is_competition,
    is_limited, is_icon, model_family, generation_code, era. Flags are false, and the rest null, where no rule fits. Make,
    engine and family are found once for each row, however many rules ask for them."""

    def engine(x: Column) -> Column:
        out = F.lit(None).cast("struct<layout:string,cyl:int>")
        for name, pattern, layout, cyl in reversed(ENGINES):
            out = F.when((x["mk"] == name) & F.lower(x["mo"]).rlike(pattern), F.struct(F.lit(layout).alias("layout"), F.lit(cyl).alias("cyl"))).otherwise(out)
        return out

    def told(x: Column) -> Column:
        mk, mo, own, motor = x["mk"], x["mo"], x["own"], x["motor"]
        fast = mk.isin(FAST_MAKES) | (F.coalesce(motor["cyl"], F.lit(0)) >= 8) | _shows(mo, FAST) | ((mk == "Mercedes-Benz") & _shows(mo, LETTER_AND_NUMBER)) | _among(mk, own, FAST_FAMILIES)
        for pattern in M_MODELS:
            fast = fast | ((mk == "BMW") & _shows(mo, pattern))
        flags = {"is_performance": fast, "is_special_edition": _shows(mo, SPECIAL), "is_competition": _shows(mo, RACING), "is_limited": _shows(mo, LIMITED), "is_icon": _among(mk, own, ICONS)}
        rest = {"model_family": own, "generation_code": generation(mo), "era": era(first_year)}
        return F.struct(motor["layout"].alias("engine_layout"), motor["cyl"].alias("engine_cyl"), *[c.alias(k) for k, c in (flags | rest).items()])

    once = lambda value, body: F.get(F.transform(F.array(value), body), F.lit(0))
    names = F.struct(canonical_make(make).alias("mk"), F.trim(F.coalesce(model, F.lit(""))).alias("mo"))
    return once(once(names, lambda x: F.struct(x["mk"].alias("mk"), x["mo"].alias("mo"), family(x["mk"], x["mo"]).alias("own"), engine(x).alias("motor"))), told)
