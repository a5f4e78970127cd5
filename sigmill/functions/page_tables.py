"""Fixed values of the page signals: keywords, patterns and terms with their confidence, in the order in which they are tried."""

#: signal -> keyword of a link's address or text -> confidence; the first link that contains one decides.
FIRST_LINK = {
    "legal.bfsg.present": {"barrierefreiheit": 90, "barrierefreiheitserklarung": 90, "barrierefreiheitserklaerung": 90, "bfsg": 90, "accessibility-statement": 90, "accessibilitystatement": 90, "barrierefreiheitshinweise": 80, "accessible": 50},
    "legal.agb.present": {
        "agb": 90, "allgemeine-geschaftsbedingungen": 90, "allgemeinegeschaftsbedingungen": 90, "allgemeine-geschaeftsbedingungen": 90, "nutzungsbedingungen": 90, "geschaftsbedingungen": 90,
        "terms-and-conditions": 80, "termsandconditions": 80, "terms-of-service": 80, "termsofservice": 80, "terms": 50,
    },
    "legal.widerruf.present": {"widerruf": 90, "widerrufsrecht": 90, "widerrufsbelehrung": 90, "widerrufsformular": 90, "right-of-withdrawal": 80, "rightofwithdrawal": 80, "cancellation-policy": 80, "cancellationpolicy": 80, "cancellation": 50},
    "legal.versand.present": {"versand": 90, "versandkosten": 90, "lieferbedingungen": 90, "lieferung": 80, "versandinformationen": 80, "shipping-and-delivery": 80, "shippinganddelivery": 80, "shipping": 60, "delivery": 60},
    "legal.impressum.present": {
        "impressum": 90, "imprint": 90, "legalnotice": 90, "legaldisclosure": 90, "anbieterkennzeichnung": 90, "rechtlichehinweise": 90, "sitenotice": 90, "provideridentification": 90,
        "legalinformation": 70, "companyinformation": 70, "verantwortlicher": 70, "haftungsausschluss": 70, "disclaimer": 60, "legal": 50,
    },
    "legal.datenschutz.present": {
        "datenschutz": 90, "datenschutzerklaerung": 90, "datenschutzhinweise": 90, "datenschutzbestimmungen": 90, "datenschutzrichtlinie": 90, "privacy": 90, "privacypolicy": 90, "privacynotice": 90, "privacystatement": 90,
        "dataprotection": 90, "gdpr": 90, "dsgvo": 90, "cookiepolicy": 70, "cookienotice": 70, "cookierichtlinie": 70, "cookiehinweis": 70, "cookieeinstellungen": 70, "privatsphaere": 70, "confidentiality": 70, "personaldata": 70, "cookie": 50,
    },
    "content.team_page.present": {
        "unser-team": 90, "unserteam": 90, "uber-uns": 85, "uberuns": 85, "about-us": 85, "aboutus": 85, "our-team": 85, "ourteam": 85, "team": 70, "mitarbeiter": 80, "wir-sind": 80, "wirstellen": 80, "unsere-mitarbeiter": 85, "uber-mich": 80, "wer-sind-wir": 85,
    },
}
#: The best link decides; a match of 85 or more ends the search.
BEST_LINK = {
    "content.portfolio.present": {"portfolio": 90, "galerie": 85, "gallery": 85, "referenzen": 80, "projekte": 75, "arbeiten": 70, "unsere-arbeiten": 80, "bildergalerie": 85, "fotogalerie": 85, "unsere-projekte": 80},
    "content.testimonials.present": {"testimonials": 90, "kundenstimmen": 90, "bewertungen": 85, "erfahrungen": 80, "meinungen": 75, "referenzen": 70, "kundenreferenzen": 85, "kundenmeinungen": 85, "reviews": 80},
    "content.case_studies.present": {
        "case-study": 90, "casestudy": 90, "case-studies": 90, "casestudies": 90, "fallstudie": 90, "fallstudien": 90, "kundenprojekt": 80, "referenzprojekt": 80, "projektbericht": 75, "erfolgsgeschichte": 75, "success-story": 75, "successstory": 75,
    },
}
#: Where no link matches: (terms of the body text or parts of ids and classes, confidence).
BODY_FALLBACK = {"content.portfolio.present": (("portfolio", "galerie", "referenzen"), 60)}
MARK_FALLBACK = {"content.testimonials.present": (("testimonial", "bewertung", "kundenstimmen"), 75)}
#: signal -> (terms, whole words, image texts count too, confidence).
BODY_TERMS = {
    "trust.certifications.present": (("zertifikat", "zertifiziert", "certification", "certified", "din ", "iso ", "tüv", "tuev", "dekra", "geprüft", "geprueft"), (), True, 70),
    "trust.awards.present": (("auszeichnung", "award", "gewinner", "winner", "ehrung", "preisträger", "preistraeger", "ausgezeichnet"), ("preis", "sieger"), True, 65),
    "trust.memberships.present": (
        ("mitglied ", "mitgliedschaft", "membership", "verband", "handwerkskammer", "handelskammer", "hwk", "ihk", "innung", "bund ", "vereinigung", "fachverband", "berufsverband", "gilde", "bundesverband", "landesverband", "zentralverband"),
        ("kammer",), False, 65,
    ),
    "trust.certification.meister.present": (("meisterbetrieb", "handwerksmeister", "meisterbrief", "meisterin", "meister ", "hwk-meister", "staatlich geprüft", "staatlich geprueft"), (), True, 80),
}
CONTACT_MARKS = ("contactform", "contact-form", "kontaktformular", "kontakt-formular")
CONTACT_ACTIONS = ("contact", "kontakt")
MAP_FRAMES = ("maps.google.com", "google.com/maps", "maps.googleapis.com", "openstreetmap.org", "maps.apple.com")
MAP_MARKS = ("map", "karte")
#: signal -> (host patterns, confidence) of external links.
HOSTS = {
    "registry.handelsregister.present": (("handelsregister.de",), 95),
    "registry.unternehmensregister.present": (("unternehmensregister.de",), 95),
    "registry.kammern.present": (("hwk", "ihk", "handwerkskammer", "handwerkskammer.de", "ihk.de", "kammern.de", "hwk.de"), 85),
    "registry.industry_catalogs.present": (("gelbeseiten.de", "yelp.de", "yelp.com", "11880.com", "meinestadt.de", "branchenbuch.de", "wlw.de", "europages.de", "firmenwissen.de", "cylex.de", "klicktel.de", "dasoertliche.de", "herold.at"), 80),
    "social.facebook.present": (("facebook.com", "fb.com", "fb.me"), 95),
    "social.instagram.present": (("instagram.com",), 95),
    "social.youtube.present": (("youtube.com", "youtu.be"), 95),
    "social.xing.present": (("xing.com",), 95),
    "social.linkedin.present": (("linkedin.com",), 95),
    "social.tiktok.present": (("tiktok.com",), 95),
    "social.whatsapp.present": (("whatsapp.com", "wa.me", "api.whatsapp.com"), 95),
    "social.pinterest.present": (("pinterest.com", "pinterest.de"), 95),
    "social.twitter.present": (("twitter.com", "x.com"), 95),
}
GOOGLE_HOSTS = ("business.google.com", "g.page", "maps.app.goo.gl", "goo.gl")
#: signal -> schema.org types, lower case.
SCHEMA_TYPES = {
    "structured_data.schema_org.local_business.present": (
        "localbusiness", "store", "restaurant", "foodestablishment", "lodgingbusiness", "healthandbeautybusiness", "homeandconstructionbusiness", "automotivebusiness", "entertainmentbusiness", "financialservice",
        "legalservice", "medicalorganization", "professionalservice", "realestateagent", "recyclingcenter", "selfstorageunit", "servicechannel", "touristinformationcenter",
    ),
    "structured_data.schema_org.service.present": ("service",),
    "structured_data.schema_org.faq.present": ("faqpage",),
    "structured_data.schema_org.how_to.present": ("howto",),
    "structured_data.schema_org.breadcrumb.present": ("breadcrumblist",),
    "structured_data.schema_org.opening_hours_spec.present": ("openinghoursspecification",),
    "structured_data.schema_org.person.present": ("person",),
    "structured_data.schema_org.review.present": ("review", "aggregaterating"),
    "structured_data.schema_org.product.present": ("product",),
}
COOKIE_MARKS = ("cookie", "consent", "gdpr")
COOKIE_IDS = ("cybotcookiebotdialog", "onetrust-banner-sdk")
COOKIE_CLASSES = ("cc-window", "cookiealert")
REJECT = r"\b(?:ablehnen|reject|decline|verweigern|nicht\s*akzeptieren|alle\s*ablehnen|deny|nur\s*notwendige|only\s*necessary|essential\s*only)\b"
ACCEPT = r"\b(?:akzeptieren|accept|zustimmen|alle\s*akzeptieren|ich\s*stimme\s*zu|allow|agree|got\s*it|verstanden|ok|einverstanden)\b"
SETTINGS = r"\b(?:einstellungen|settings|anpassen|customize|customise|preferences|cookie-einstellungen|details|verwalten|manage|optionen|options)\b"
REVOKE = r"\b(?:widerrufen|widerruf|revoke|withdraw|widerrufsrecht|einwilligung\s*widerrufen|consent\s*withdraw)\b"
