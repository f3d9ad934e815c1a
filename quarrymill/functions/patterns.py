"""Patterns that show a feature in a text, by language: fixed values, which more languages or features can be added to."""

from __future__ import annotations

# Fixed values.
DUTCH = {
    "carnet_present": [r"onderhoudsboekje[s]?[:\s]+aanwezig", r"service[\s\-]?historie", r"instructieboekjes?\s+aanwezig", r"onderhoudshistorie", r"onderhoudsboekje", r"servicebeurten"],
    "carnet_complet": [r"onderhoudsboekje[s]?\s+volledig", r"compleet\s+onderhouden", r"volledig(?:e)?\s+onderhoud(?:shistorie)?", r"compleet\s+onderhoudsboekje", r"alle\s+beurten"],
    "factures_completes": [r"facturen\s+(?:aanwezig|beschikbaar)", r"alle\s+facturen", r"bonnen\s+aanwezig"],
    "first_owner": [r"eerste\s+eigenaar", r"één\s+eigenaar"],
    "suivi_constructeur": [r"dealer\s+onderhouden", r"dealeronderhoudshistorie", r"merkdealer", r"bij\s+(?:de\s+)?(?:officiele|merk)?dealer"],
    "suivi_specialiste": [r"merkspecialist", r"gespecialiseerde\s+garage"],
    "sous_garantie_constructeur": [r"fabrieksgarantie"],
    "garantie_extension": [r"garantieverlenging"],
    "garage_chauffe": [r"verwarmde\s+garage"],
    "garage_climatise": [r"geklimatiseerd"],
    "etat_concours": [r"concours\s*(?:staat|conditie)", r"topstaat"],
    "etat_origine": [r"originele\s+staat", r"ongerestaureerd", r"volledig\s+origineel"],
    "peinture_origine": [r"originele\s+lak"],
    "peinture_refaite": [r"overgespoten", r"opnieuw\s+gespoten"],
    "pneus_neufs": [r"nieuwe\s+banden"],
    "revision_recente": [r"recent\s+onderhouden", r"grote\s+beurt"],
    "matching_numbers": [r"matching\s+numbers?", r"originele\s+motor"],
    "certificat_constructeur": [r"fabrieks(?:certificaat|verklaring)", r"certificaat\s+van\s+echtheid"],
    "serie_limitee": [r"limited\s+edition", r"gelimiteerde\s+oplage", r"één\s+van\s+\d+"],
}

# Fixed values.
FRENCH = {
    "carnet_present": [r"carnet\s+(?:d[\'e]\s*)?entretien", r"historique\s+entretien", r"carnet\s+de\s+bord", r"suivi\s+d[\'’]?entretien", r"historique\s+complet"],
    "carnet_complet": [r"carnet\s+(?:d[\'e]\s*)?entretien\s+complet", r"entretien\s+suivi", r"historique\s+(?:d[\'’]?entretien\s+)?complet", r"tous\s+les\s+entretiens", r"entretiens?\s+(?:a\s+jour|à\s+jour)"],
    "first_owner": [r"premi[èe]re\s+main", r"1[èeé]re\s+main", r"\b1\s*(?:ère|ere|re)\s+main\b", r"un\s+seul\s+propriétaire", r"premier\s+propriétaire"],
    "factures_completes": [r"factures?\s+(?:d[\'’]?entretien|disponibles?|à\s+l[\'’]?appui|jointes?)", r"toutes\s+les\s+factures", r"nombreuses\s+factures", r"classeur\s+de\s+factures"],
    "suivi_constructeur": [r"entretien\s+concessionnaire", r"suivi\s+(?:en\s+)?concession", r"chez\s+(?:le\s+)?concessionnaire", r"historique\s+(?:d\'?\s*)?entretien\s+concession"],
    "suivi_specialiste": [r"spécialiste\s+(?:de\s+la\s+)?marque", r"garage\s+spécialisé", r"atelier\s+spécialisé", r"préparateur\s+reconnu"],
    "garage_chauffe": [r"garage[^.\n]{0,30}chauff[ée]"],
    "garage_climatise": [r"garage\s+climatisé", r"stockage\s+climatisé"],
    "stockage_exterieur": [r"stationnée?\s+dehors", r"garée?\s+à\s+l[\'’]?extérieur"],
    "etat_origine": [r"exemplaire\s+d['’]origine", r"non[\s\-]+modifi[ée]", r"[ée]tat\s+d['’]origine"],
    "etat_concours": [r"état\s+concours", r"niveau\s+concours", r"concours\s+d[\'’]?élégance", r"restauration\s+concours"],
    "peinture_origine": [r"peinture\s+(?:d[\'’])?origine", r"teinte\s+d[\'’]?origine"],
    "peinture_refaite": [r"peinture\s+(?:refaite|neuve)", r"repeinte"],
    "pneus_neufs": [r"pneus\s+(?:neufs|neuves)", r"train\s+de\s+pneus\s+neuf"],
    "revision_recente": [r"révision\s+(?:récente|effectuée)", r"grand\s+entretien\s+(?:fait|réalisé)"],
    "sous_garantie_constructeur": [r"sous\s+garantie\s+(?:constructeur|usine)", r"garantie\s+constructeur\s+jusqu"],
    "garantie_extension": [r"extension\s+de\s+garantie", r"garantie\s+prolongée"],
    "matching_numbers": [r"matching\s+numbers?", r"numéros\s+concordants", r"moteur\s+(?:et\s+boîte\s+)?d[\'’]?origine"],
    "certificat_constructeur": [r"certificat\s+(?:d[\'’]?authenticité|constructeur)", r"attestation\s+constructeur", r"fiche\s+de\s+production"],
    "serie_limitee": [r"série\s+limitée", r"édition\s+limitée", r"(?:seulement|que|produite?s?\s+a|limitee?\s+a)\s+\d{1,4}\s+exemplaires?\b", r"numérotée?\s+\d"],
}

# Fixed values.
GERMAN = {
    "carnet_present": [r"serviceheft\s+vorhanden", r"scheckheft\s+(?:vorhanden|gepflegt)", r"checkheft", r"wartungsheft", r"servicehistorie"],
    "carnet_complet": [r"scheckheftgepflegt", r"serviceheft\s+(?:vollst[äa]ndig|komplett)", r"lückenlos(?:e[rns]?)?\s+(?:scheckheft|historie|service)", r"lückenlose\s+wartung", r"komplette\s+historie"],
    "first_owner": [r"erstbesitzer", r"erste\s+hand", r"1\.\s*hand", r"erstbesitz"],
    "factures_completes": [r"rechnungen\s+(?:vorhanden|liegen\s+vor|verfügbar)", r"alle\s+rechnungen", r"rechnungsordner", r"belege\s+vorhanden"],
    "etat_origine": [r"originalzustand"],
    "etat_concours": [r"zustandsnote\s*1", r"concours[\s\-]?zustand", r"note\s*1\s*zustand"],
    "peinture_origine": [r"originallack", r"erstlack"],
    "peinture_refaite": [r"neu\s+lackiert", r"komplettlackierung"],
    "pneus_neufs": [r"neue\s+reifen", r"reifen\s+neu"],
    "revision_recente": [r"große\s+inspektion", r"frisch\s+gewartet", r"service\s+neu"],
    "suivi_constructeur": [r"(?:vertrags)?händler\s+gewartet", r"beim\s+(?:vertrags)?händler"],
    "suivi_specialiste": [r"fachwerkstatt", r"spezialist\s+gewartet"],
    "sous_garantie_constructeur": [r"werksgarantie", r"herstellergarantie"],
    "garantie_extension": [r"garantieverlängerung", r"anschlussgarantie"],
    "garage_chauffe": [r"beheizte[rn]?\s+garage"],
    "garage_climatise": [r"klimatisiert"],
    "stockage_exterieur": [r"im\s+freien\s+(?:gestanden|abgestellt)"],
    "matching_numbers": [r"nummerngleich", r"matching\s+numbers?", r"originalmotor"],
    "certificat_constructeur": [r"(?:werks)?zertifikat", r"geburtsurkunde", r"datenkarte"],
    "serie_limitee": [r"limitierte?\s+(?:auflage|edition)", r"sondermodell", r"\b\d{1,4}\s+stück\s+gebaut", r"eines\s+von\s+\d+"],
}

# Fixed values.
ITALIAN = {
    "carnet_present": [r"libretto\s+(?:di\s+)?manutenzione", r"libretto\s+tagliandi", r"tagliandi", r"storico\s+manutenzione", r"libretto\s+service"],
    "carnet_complet": [r"libretto\s+tagliandi(?:\s+completo)?", r"tagliandi\s+regolari", r"tagliandi\s+(?:completi|regolari|certificati)", r"storico\s+completo", r"manutenzione\s+completa"],
    "first_owner": [r"primo\s+proprietario", r"prima\s+mano", r"unico\s+proprietario"],
    "factures_completes": [r"fatture\s+(?:disponibili|presenti|allegate)", r"tutte\s+le\s+fatture", r"ricevute\s+disponibili"],
    "suivi_constructeur": [r"concessionaria(?:rio)?\s+ufficiale", r"assistenza\s+ufficiale"],
    "suivi_specialiste": [r"officina\s+specializzata", r"specialista\s+del\s+marchio"],
    "sous_garantie_constructeur": [r"garanzia\s+(?:ufficiale|casa\s+madre)"],
    "garantie_extension": [r"estensione\s+(?:di\s+)?garanzia"],
    "garage_chauffe": [r"box\s+riscaldato"],
    "garage_climatise": [r"climatizzato"],
    "etat_concours": [r"da\s+concorso", r"concorso\s+d[\'’]?eleganza", r"restauro\s+da\s+concorso"],
    "etat_origine": [r"condizioni\s+originali", r"mai\s+restaurata", r"tutto\s+originale"],
    "peinture_origine": [r"vernice\s+originale"],
    "peinture_refaite": [r"riverniciata"],
    "pneus_neufs": [r"gomme\s+nuove", r"pneumatici\s+nuovi"],
    "revision_recente": [r"tagliando\s+(?:appena\s+)?(?:fatto|eseguito)", r"revisione\s+recente"],
    "matching_numbers": [r"matching\s+numbers?", r"numeri\s+corrispondenti", r"motore\s+originale"],
    "certificat_constructeur": [r"certificato\s+di\s+origine", r"certificat[oa]\s+(?:classiche|autenticità)", r"attestato\s+di\s+storicità"],
    "serie_limitee": [r"serie\s+limitata", r"edizione\s+limitata", r"uno\s+di\s+\d+", r"\b\d{1,4}\s+esemplari\b"],
}

# Fixed values.
ENGLISH = {
    "carnet_present": [r"service\s+history", r"service\s+book", r"service\s+records?", r"maintenance\s+history", r"stamped\s+(?:service\s+)?book"],
    "carnet_complet": [r"full\s+service\s+history", r"\bfsh\b", r"complete\s+service\s+history", r"comprehensive\s+(?:service\s+)?history", r"full\s+history", r"extensive\s+history\s+file"],
    "first_owner": [r"one\s+owner", r"first\s+owner", r"one\s+owner\s+from\s+new", r"single\s+owner", r"\b1\s+owner\b", r"former\s+keepers?\s*:?\s*(?:0|1|one)\b"],
    "factures_completes": [r"invoices?\s+(?:available|on\s+file|present)", r"all\s+invoices", r"receipts?\s+(?:available|on\s+file)", r"history\s+file\s+(?:with|of)\s+(?:invoices|bills)"],
    "suivi_constructeur": [r"main\s+dealer\s+(?:serviced|history)", r"franchise\s+dealer"],
    "suivi_specialiste": [r"specialist\s+(?:serviced|maintained)", r"marque\s+specialist"],
    "sous_garantie_constructeur": [r"(?:manufacturer|factory)\s+warranty", r"still\s+under\s+warranty"],
    "garantie_extension": [r"extended\s+warranty"],
    "garage_chauffe": [r"heated\s+garage"],
    "garage_climatise": [r"climate[\s\-]?controlled"],
    "stockage_exterieur": [r"stored\s+outside", r"kept\s+outdoors"],
    "etat_concours": [r"concours\s+(?:condition|ready|standard|winner)", r"show\s+condition"],
    "etat_origine": [r"original\s+condition", r"unrestored", r"all\s+original", r"unmolested"],
    "peinture_origine": [r"original\s+paint", r"factory\s+paint"],
    "peinture_refaite": [r"(?:repainted|resprayed)", r"bare\s+metal\s+respray"],
    "pneus_neufs": [r"new\s+tyres?", r"new\s+tires?"],
    "revision_recente": [r"(?:recently|just)\s+serviced", r"major\s+service\s+(?:done|completed)", r"fresh\s+service"],
    "matching_numbers": [r"matching\s+numbers?", r"numbers\s+matching", r"original\s+(?:engine|matching)\s+(?:and\s+gearbox)?"],
    "certificat_constructeur": [r"(?:heritage|build)\s+certificate", r"certificate\s+of\s+authenticity", r"factory\s+build\s+sheet", r"\bbmiht\b"],
    "serie_limitee": [r"limited\s+edition", r"one\s+of\s+(?:just\s+|only\s+)?\d+", r"(?:only|just|merely)\s+\d{1,4}\s+(?:ever\s+)?(?:made|built|produced)\b"],
}

PATTERNS = {"nl": DUTCH, "fr": FRENCH, "de": GERMAN, "it": ITALIAN, "en": ENGLISH}

# What rules a pattern out where it stands right before, for all languages.
NEGATIONS = [
    r"\b(?:sans|aucun[e]?|pas\s+de|manque[nt]?\s+(?:le|la|les)?)\s+",
    r"\b(?:no|without|missing|lacks?|not)\s+",
    r"\b(?:kein[e]?|ohne|fehlt|fehlen)\s+",
    r"\b(?:senza|nessun[ao]?|manca(?:no)?)\s+",
    r"\b(?:zonder|geen|ontbreekt)\s+",
    r"\bhors\s+",
    r"\bnon\s+",
    r"\bnicht\s+",
]
