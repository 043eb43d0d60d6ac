"""Personal information in free text, by anchors and local parsers.

An Aho-Corasick automaton finds at-signs and cue words in one pass over a text.
Each hit is handed to the parser of its anchor, a pattern matched at (or ending
at) that place, which expands it to a mention and validates its shape.  Nothing
is searched for outside the reach of an anchor.
"""

from __future__ import annotations

import re
from bisect import bisect_right, insort
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Typed placeholders.
PLACEHOLDERS = {"name": "<NAME>", "email": "<EMAIL>", "phone": "<PHONE>", "id_number": "<ID>", "street": "<STREET>"}
#: How far a parser looks back from its anchor, in code points.
REACH = 200

# --- shapes -----------------------------------------------------------------
_UP, _LOW = "A-ZÀ-ÖØ-Þ", "a-zß-öø-ÿ"
_TITLE = r"(?:(?:Prof|PD|Priv|Doz|Dr|med|Dipl\.-Med|Ass\.-Arzt|Ass\.-Ärztin|OA|OÄ|CA|CÄ|Hr|Fr|Herrn?|Frau|Patientin|Patient(?:en)?|Pat|Mrs?|Ms|Mme|Mlle|Pr|Schwester|Pfleger)\.?{s}+)*"
_FRENCH = r"(?:(?:le{s}+|la{s}+)?(?:M|Mme|Mlle|Dr|Pr|Mr)\.?{s}+)*"
_W = rf"[{_UP}](?:[{_LOW}]|['’](?=[{_UP}{_LOW}]))+(?:-[{_UP}][{_LOW}]+)*"
_PART = r"(?:(?:von{s}+der|von|van{s}+de[rn]?|van|zum?|zur|vom|de{s}+la|de|du|di|al){s}+)?"
_NAME = (
    rf"(?:[{_UP}]{{3,}}(?:-[{_UP}]+)*,{{s}}+(?:{_W}|[{_UP}]\.)"  # SURNAME, Given
    rf"|{_PART}{_W},{{s}}+[{_UP}]\.(?!{{s}}+(?:von{{s}}+)?[{_UP}][{_LOW}])"  # Surname, G.
    rf"|(?:(?:{_W}|[{_UP}]\.(?:{{s}}?[{_UP}]\.)*){{s}}+)?{_PART}{_W}"  # Given Surname, G. Surname, Surname
    r"{low})"
)
_SMALL = rf"|[{_LOW}]{{2,}}{{s}}+{_PART}[{_LOW}]{{3,}}(?:-[{_LOW}]+)*"  # given surname

_SEP = r"(?:\.|\s?[-/]\s?|[^\S\r\n]|\s(?=\d\d)|\)[^\S\r\n]?|\()?"
PHONE = rf"(?:(?:\+|00)\d{{1,3}}(?:{_SEP}{_SEP}\d){{6,13}}|\(0\d{{1,5}}\)(?:{_SEP}\d){{4,12}}|\(\d{{3}}\)\s?\d{{3}}-\d{{4}}|0\d(?:{_SEP}\d){{5,12}}|1\d\d[ -]?\d{{4}}[ -]?\d{{4}}|\d{{4,6}}(?!\d))"
ID = r"(?:[A-Z]{1,3}\s?\d{2,3}(?:\s\d{2,3}){2,3}(?:\s[A-Z]\b)?|\d{3}(?:\s\d{3,4}){2}|[A-Z]?\d[\dA-Z]*(?:-[\dA-Z]+)*\d)"
STREET = rf"(?:[{_UP}][{_UP}{_LOW}.\-]+(?:\s+[{_UP}{_LOW}][{_UP}{_LOW}.\-]*){{0,4}}\s+\d{{1,4}}(?:\s?[a-z](?![{_LOW}]))?(?:\s?[-/]\s?\d{{1,4}}(?:\s?[a-z](?![{_LOW}]))?)?)"
STREET_EN = rf"(?:\d{{1,4}}[A-Za-z]?\s+(?:[{_UP}][{_UP}{_LOW}.'’\-]*\s+){{0,4}}[{_UP}][{_LOW}]+\.?)"
HAN, THAI, DEVA, ARAB = "㐀-鿿々", "฀-๿", "ऀ-ॿ", "؀-ۿ"
_EMAIL = re.compile(r"(?P<l>[A-Za-z0-9][A-Za-z0-9._%+\-]*)(?P<a>\s?[(\[]\s?at\s?[)\]]\s?|@)(?P<d>[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,})")
_LOCAL = re.compile(r"[A-Za-z0-9][A-Za-z0-9._%+\-]*\s?\Z")


def _p(pattern: str, inline: bool = False, small: bool = False) -> re.Pattern:
    """A parser: {N} name, {T} titles, {F} French titles, {P} phone, {I} id, {S} street.

    ``inline``: the blanks inside names don't reach over a line end.
    """
    s = r"[^\S\r\n]" if inline else r"\s"
    low = _SMALL if small else ""
    fill = {"N": _NAME.replace("{low}", low).replace("{s}", s), "T": _TITLE.replace("{s}", s), "F": _FRENCH.replace("{s}", s), "P": PHONE, "I": ID, "S": STREET, "E": STREET_EN, "H": HAN, "TH": THAI, "D": DEVA, "A": ARAB}
    for k, v in fill.items():
        pattern = pattern.replace("{" + k + "}", v)
    return re.compile(pattern)


_KIN = "Ehefrau|Ehemann|Ehegatte|Ehegattin|Tochter|Sohn|Bruder|Schwester|Mutter|Vater|Betreuer|Betreuerin|Lebensgefährtin|Lebensgefährte|Partnerin|Partner|Nichte|Neffe|Enkelin|Enkel|Angehörige|Angehöriger"

#: Anchor: parsers matched at the anchor's start.  Groups are named by their
#: type: n name, p phone, i id_number, s street, with a figure where repeated.
_AHEAD: dict[str, list[re.Pattern]] = {
    # fixed values: cue words of the mentions
    "Notfallkontakt": [_p(r"Notfallkontakt\s+von\s+{T}(?P<n>{N})\s+lautet\s+(?P<p>{P})")],
    "abgelegt": [_p(r"abgelegt\s+und\s+wurde\s+{T}(?P<n>{N})\s+zugeordnet")],
    "Wunsch": [_p(r"Wunsch\s+von\s+{T}(?P<n>{N})\s+geht\s+eine\s+Kopie\s+an\s+die\s+(?P<s>{S})\s+in\b")],
    "Anforderung": [_p(r"Anforderung\s+durch\s+{T}(?P<n>{N})(?=\s*[,.;(]|\s*$)")],
    "Rückfragen": [_p(r"Rückfragen\s+bitte\s+an\s+{T}(?P<n>{N})(?:,?\s+\(?Tel\.?:?\s+(?P<p>{P}))?"), _p(r"Rückfragen:\s+\S+(?:\s?[(\[]\s?at\s?[)\]]\s?\S+)?\s+oder\s+(?P<p>{P})")],
    "telefonisch": [_p(r"telefonisch\s+an\s+{T}(?P<n>{N})\s+\((?P<p>{P})\)"), _p(r"telefonisch\s+mit\s+{T}(?P<n>{N})", True, True)],
    "Indikation": [_p(r"Indikation\s+wurde\s+mit\s+{T}(?P<n>{N})(?:\s*,|\s+/|\s+und)\s+{T}(?P<n2>{N})\s+besprochen"), _p(r"Indikation\s+wurde\s+mit\s+{T}(?P<n>{N})\s+besprochen")],
    "Freigabe": [_p(r"Freigabe\s+(?:von|durch)\s+{T}(?P<n>{N})", True, True)],
    "Kopie": [_p(r"Kopie\s+an\s+(?!die\b|den\b|das\b){T}(?P<n>{N})(?:,\s+(?P<s>{S})(?=\s*,))?", True, True), _p(r"Kopie\s+an\s+(?!die\b|den\b|das\b){T}(?P<n>{N}),\s+(?P<s>{S})(?=\s*,)")],
    "gez.": [_p(r"gez\.\s+{T}(?P<n>{N})", True, True)],
    "i. A.": [_p(r"i\. A\.\s+{T}(?P<n>{N})", True, True)],
    "Vidiert": [_p(r"Vidiert:\s+{T}(?P<n>{N})(?:,\s+Durchwahl:?\s+(?P<p>{P}))?", True, True)],
    "Untersucher": [_p(r"Untersucher(?:in)?:\s+{T}(?P<n>{N})(?:(?:\s*,|\s+/|\s+und)\s+{T}(?P<n2>{N}))?", True, True)],
    "wohnhaft": [_p(r"wohnhaft\s+(?P<s>{S})(?=\s*[,.])")],
    "Adresse": [_p(r"Adresse\s+jetzt\s+(?P<s>{S})")],
    "Termin": [_p(r"Termin\s+unter\s+(?P<p>{P})\s+vereinbaren")],
    "Durchwahl": [_p(r"Durchwahl:?\s+(?P<p>{P})")],
    "Tel.": [_p(r"Tel\.:?\s+(?P<p>{P})")],
    "reached": [_p(r"reached\s+at\s+(?P<p>{P})")],
    "phoned": [_p(r"phoned\s+to\s+{T}(?P<n>{N})\s+at\s+(?P<p>{P})")],
    "signed": [_p(r"signed\s+by\s+{T}(?P<n>{N})(?=\s*[.,]|\s*$)"), _p(r"signed:\s+{T}(?P<n>{N})(?:,\s+ext\.\s+line\s+(?P<p>{P}))?", True, True)],
    "seen by": [_p(r"seen\s+by\s+{T}(?P<n>{N})\s+on\b")],
    "Reported": [_p(r"Reported\s+by\s+{T}(?P<n>{N})", True, True)],
    "validé": [_p(r"validé\s+par\s+{F}(?P<n>{N})", True, True)],
    "vérifié": [_p(r"vérifié\s+par\s+{F}(?P<n>{N})(?=\s*[.,]|\s*$)")],
    "demandé": [_p(r"demandé\s+par\s+{F}(?P<n>{N})(?:,\s+tél\.\s+(?P<p>{P}))?(?=\s*[.,]|\s*$)")],
    "tél.": [_p(r"tél\.\s+(?P<p>{P})")],
    "patient n°": [_p(r"patient\s+n°\s+(?P<i>{I})")],
    "MRN": [_p(r"MRN:?\s+(?P<i>{I})")],
    "NHS": [_p(r"NHS\s+(?:no\.|number):?\s+(?P<i>{I})")],
    "record no": [_p(r"record\s+no\.?\s+(?P<i>{I})")],
    "patient no": [_p(r"patient\s+no\.?\s+(?P<i>{I})")],
    "Fall": [_p(r"Fall(?:nummer|nr\.?|-?Nr\.?)\s*:?\s+(?P<i>{I})")],
    "Pat": [_p(r"Pat(?:ientennummer|ienten-?Nr\.?|\.?-Nr\.?|\.?-ID)\s*:?\s+(?P<i>{I})")],
    "PID": [_p(r"PID\s*:?\s+(?P<i>{I})")],
    "KV": [_p(r"KV(?:NR|-Nr\.?|-Nummer)\s*:?\s+(?P<i>{I})")],
    "Vers": [_p(r"Vers(?:ichertennummer|icherten-?Nr\.?|icherungsnummer|\.?-Nr\.?)\s*:?\s+(?P<i>{I})")],
    "Ausweis": [_p(r"Ausweis(?:nummer|nr\.?|-Nr\.?)\s*:?\s+(?P<i>{I})")],
    "ausweis": [_p(r"ausweis(?:nummer|nr\.?|-Nr\.?)?\s*:?\s+(?P<i>{I})")],
    # titles on their own
    **{t: [_p(rf"{re.escape(t)}\s+{{T}}(?P<n>{{N}})", True)] for t in ("Dr.", "Prof.", "Hr.", "Fr.", "Herr", "Frau", "Mr.", "Mrs.", "Ms.", "OA", "OÄ")},
    **{k: [_p(rf"(?:{k})\s+(?:Herr\s+|Frau\s+)?{{T}}(?P<n>{{N}})\s+(?:sei|ist|hat|wurde|lautet)\b")] for k in _KIN.split("|")},
    # Chinese and Japanese
    "患者": [_p(r"患者(?P<n>[{H}]{2,4}?)于"), _p(r"患者番号\s?(?P<i>\d{5,})")],
    "医师": [_p(r"医师[：:]\s?(?P<n>[{H}]{2,4})(?![{H}])")],
    "住址": [_p(r"住址[：:]\s?(?P<s>[^，。\s]{2,30}?\d+号)")],
    "身份证号": [_p(r"身份证号[：:]?\s?(?P<i>\d{17}[\dXx])")],
    "連絡先": [_p(r"連絡先[は：:]\s?(?P<p>{P})(?:、担当[は：:]\s?(?P<n>[{H}]{2,4}?(?:[ 　][{H}]{1,3})?)(?:医師|先生|様|さん))?")],
    "请联系": [_p(r"请联系(?P<n>[{H}]{2,4}?)(?:医生|医师|护士|主任)(?:，电话[：:]?\s?(?P<p>{P}))?")],
    "電話": [_p(r"電話(?:番号)?[はの：:]?\s?(?P<p>{P})")],
    "电话": [_p(r"电话[：:]?\s?(?P<p>{P})")],
    "読影医": [_p(r"読影医[：:]\s?(?P<n>[{H}]{1,4}(?:[ 　][{H}]{1,4})?)(?![{H}])")],
    "住所": [_p(r"住所[は：:]\s?(?P<s>[^、。\s]{2,30}?\d+(?:-\d+)+)")],
    # Thai
    "ผู้รายงาน": [_p(r"ผู้รายงาน\s?(?:นางสาว|นายแพทย์|นาย|นาง|แพทย์หญิง|พญ\.|นพ\.|คุณ|ดร\.)\s?(?P<n>[{TH}]+(?:[^\S\r\n][{TH}]+)?)(?=\s*$|[\r\n])"), _p(r"ผู้รายงาน\s?(?:นางสาว|นาย|นาง|คุณ|ดร\.)\s?(?P<n>[{TH}]+)")],
    "ผู้ป่วยคือ": [_p(r"ผู้ป่วยคือ\s?(?:นางสาว|นาย|นาง|คุณ|ดร\.)\s?(?P<n>[{TH}]+)")],
    "หมายเลข": [_p(r"หมายเลข(?:โทรศัพท์)?\s?(?P<p>{P})")],
    "บ้านเลขที่": [_p(r"บ้านเลขที่\s?(?P<s>\d+(?:/\d+)?\s(?:ถนน|ซอย)[{TH}]+)")],
    "ประจำตัวผู้ป่วย": [_p(r"ประจำตัวผู้ป่วย\s?(?P<i>\d{5,})")],
    # Hindi
    "डॉ.": [_p(r"डॉ\.\s?(?P<n>[{D}]+\s[{D}]+?)(?=\s+से\b|\s*$|\s*[\r\n।,])"), _p(r"डॉ\.\s?(?P<n>[{D}]+[^\S\r\n][{D}]+)")],
    "पता": [_p(r"पता\s+(?P<s>\d+[A-Za-z]?,\s+[{D}]+(?:\s+[{D}]+)*?)\s+है")],
    "संख्या": [_p(r"संख्या\s+(?P<i>\d{5,})")],
    "संपर्क": [],
    "+91": [_p(r"(?P<p>\+91[\s-]?\d{5}[\s-]?\d{5})")],
    # Arabic
    "حضر المريض": [_p(r"حضر المريض\s+(?P<n>[{A}]+\s+[{A}]+)\s+بتاريخ")],
    "حضرت المريضة": [_p(r"حضرت المريضة\s+(?P<n>[{A}]+\s+[{A}]+)\s+بتاريخ")],
    "بالدكتور": [_p(r"بالدكتور[ة]?\s+(?P<n>[{A}]+\s+[{A}]+)\s+على\s+الرقم\s+(?P<p>{P})")],
    "التقرير": [_p(r"التقرير\s+(?:د\.\s+)?(?P<n>[{A}]+[^\S\r\n]+[{A}]+)")],
    "العنوان": [_p(r"العنوان\s+(?P<s>[{A}\s]{4,50}?\s\d+)")],
    "رقم المريض": [_p(r"رقم المريض\s+(?P<i>\d{5,})")],
}
#: Anchor: parsers whose match ends right before the anchor.
_BEHIND: dict[str, list[re.Pattern]] = {
    "aufgeklärt": [_p(r"(?:^|[\s“\".!?:])(?:{T})(?P<n>{N})\s+wurde\s+am\s+[^\r\n]{4,20}?\s+durch\s+{T}(?P<n2>{N})\s+\Z"), _p(r"durch\s+{T}(?P<n>{N})\s+\Z")],
    "wohnhaft": [_p(r"{T}(?P<n>{N}),\s+\Z")],
    "E-Mail": [_p(r"(?:\A|[\r\n])[^\S\r\n]*{T}(?P<n>{N}),\s+\Z", True, True)],
    "erreichbar": [_p(r"unter\s+(?P<p>{P})\s+\Z")],
    "can be reached": [_p(r"{T}(?P<n>{N})\s+\Z")],
    "was seen by": [_p(r"{T}(?P<n>{N})\s+of\s+(?P<s>{E})\s+\Z")],
    "様": [_p(r"(?P<n>[{H}]{1,3}[ 　][{H}]{1,3}|[{H}]{2,6})\Z")],
    "की जाँच": [_p(r"(?:^|[।?!.\r\n])\s*(?P<n>[{D}]+\s+[{D}]+)\s+\Z")],
}
# --- anchors that announce themselves, whatever sentence they stand in ---------------
#: Words for a person by role, kin or form of address.
_ROLES = (
    "Ansprechpartner|Ansprechpartnerin|Ansprechperson|Kontaktperson|Kontakt|Name|Nachname|Patientenname|Patient|Patientin|Hausarzt|Hausärztin|Oberarzt|Oberärztin|Chefarzt|Chefärztin|Stationsarzt|Stationsärztin|Assistenzarzt|Assistenzärztin|"
    "Facharzt|Fachärztin|Arzt|Ärztin|Radiologe|Radiologin|Befunder|Befunderin|Untersucherin|Überweiser|Zuweiser|Zuweiserin|Einsender|Einsenderin|Sachbearbeiter|Sachbearbeiterin|Betreuer|Betreuerin|Pflegekraft|Therapeut|Therapeutin|Auftraggeber|Unterschrift|"
    "Contact|Patient name|Referring physician|Physician|Radiologist|Attending|Consultant|Signature|Next of kin|Médecin|Radiologue|Nom"
)
#: Forms of address and degrees that a name follows.
_FORMS = ("Herrn", "Herr", "Frau", "Hrn.", "Dr.", "Dres.", "Prof.", "PD", "Monsieur", "Madame", "Mme", "Mlle", "Sister", "Nurse")
#: Labels of telephone numbers.
_LINES = ("Telefonnummer", "Telefon", "Telefax", "Tel", "Mobil", "Mobilnummer", "Handy", "Handynummer", "Rufnummer", "Fax", "phone", "Phone", "mobile", "Mobile", "telephone", "Telephone", "call", "Call", "téléphone", "portable", "tel:", "lautet", "Nebenstelle", "Pieper", "extension", "ext.")
#: Labels of identity and record numbers.
_NUMBERS = (
    "Versichertennummer", "Krankenversichertennummer", "Versicherungsnummer", "Sozialversicherungsnummer", "Personalausweis", "Ausweisnummer", "Reisepass", "Passnummer", "Aktenzeichen", "Fallnummer", "Fall-ID", "Patientennummer", "Patienten-ID", "Patientenakte", "Aufnahmenummer", "Steuer-ID",
    "Hospital number", "hospital number", "Passport", "passport", "ID card", "Insurance number", "insurance number", "Case number", "case number", "Medical record number", "medical record number", "numéro de dossier", "numéro de sécurité sociale",
)
#: What names of streets end with; those of the second list are also
#: parts of the body or of devices, and need a postcode or a word for living there.
_STREETS = ("straße", "strasse", "str.", "Straße", "Str.", "gasse", "allee", "Allee", "chaussee", "Chaussee", "promenade", "Promenade")
_PLACES = ("weg", "platz", "Platz", "ring", "damm", "ufer", "hof", "Weg", "Ring", "Damm", "Ufer", "steig", "graben", "berg")
_ROADS = ("Street", "Road", "Avenue", "Lane", "Drive", "Square", "Terrace", "Crescent", "Close", "Gardens")
_VOIES = ("rue ", "avenue ", "boulevard ", "place ", "chemin ", "impasse ", "quai ")

_TWO = rf"(?:(?:{_W}|[{_UP}]\.)[^\S\r\n]+)+{_PART.replace('{s}', r'[^\S\r\n]')}{_W}"
_HOUSE = rf"\d{{1,4}}(?:[^\S\r\n]?[a-z](?![{_LOW}]))?(?:[^\S\r\n]?[-/–][^\S\r\n]?\d{{1,4}}(?:[^\S\r\n]?[a-z](?![{_LOW}]))?)?"
_NO_UNIT = r"(?![\d.,]*\d|[^\S\r\n]?(?:%|°|mm|cm|ml|mg|kg|Uhr|Jahre|Monate|Wochen|Tage|mSv|HE)\b)"
_LINE = re.compile(rf"(?:-?(?:nummer|Nr\.?|number|no\.?))?[^\S\r\n]*[:.]?[^\S\r\n]*(?:ist|is|est|unter|at|on|on:|under|le|au)?[^\S\r\n]*(?P<p>(?:\+|00|\(?0)?\d(?:[ \t/().–-]{{0,2}}\d){{3,14}})(?![\d])")
_PLUS = re.compile(r"\+[ ]?(?:\(?\d\)?[ /().–-]{0,2}){7,14}\d")
_ZEROS = re.compile(r"00[1-9]\d?(?:[ /().–-]{0,2}\d){7,12}(?!\d)")
_IBAN = re.compile(r"[A-Z]{2}\d{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_LABELLED = re.compile(r"(?:-?(?:[Nn]ummer|Nr\.?|number|no\.?|n°))?[^\S\r\n]*(?:[:.#]|lautet|ist|is|est)?[^\S\r\n]*(?:Nr\.?|no\.?|n°)?[^\S\r\n]*(?P<i>(?=[A-Z0-9 /-]*\d[A-Z0-9 /-]*\d[A-Z0-9 /-]*\d[A-Z0-9 /-]*\d)[A-Z0-9](?:[ /-]?[A-Z0-9]){4,24})(?![A-Za-z0-9])")
_AFTER_ROLE = re.compile(rf"[^\S\r\n]*:[^\S\r\n]*{_TITLE.replace('{s}', '[^' + chr(92) + 'S' + chr(92) + 'r' + chr(92) + 'n]')}(?P<n>{_TWO}|[{_UP}]{{3,}},[^\S\r\n]+{_W}|{_W},[^\S\r\n]+(?:{_W}|[{_UP}]\.)|{_W})(?![{_LOW}])")
_AFTER_PATIENT = re.compile(rf"(?:in|en)?[^\S\r\n]+(?P<n>{_TWO})(?![{_LOW}])")
_BEFORE_PHONE = re.compile(rf"(?:\A|[\r\n(:;„\"][^\S\r\n]*|\b(?:bei|an|mit|von|durch|für|über|ist|sind|to|from|by|with|is|call|chez|par|avec)[^\S\r\n]+)(?P<n>{_TWO})[^\S\r\n]*(?:,|:|;|\(|unter|at|on|–|-|ist|is|kann|can)[^\S\r\n]*(?:unter|at|on|Tel\.?:?|Telefon:?|Mobil:?)?[^\S\r\n]*(?:der|the|seiner|ihrer)?[^\S\r\n]*\Z")
_STREET_HEAD = re.compile(rf"(?:(?:An?[^\S\r\n]+der|Am|An|Auf[^\S\r\n]+der|Auf[^\S\r\n]+dem|Zum|Zur|Im|In[^\S\r\n]+der|Alte[rn]?|Neue[rn]?|Große[rn]?|Kleine[rn]?|Obere[rn]?|Untere[rn]?|[{_UP}][{_LOW}]+er|(?:[{_UP}][{_LOW}]+-)+)[^\S\r\n]*)*(?:[{_UP}][{_UP}{_LOW}]*-?)*\Z")
_STREET_TAIL = re.compile(rf"[^\S\r\n]+{_HOUSE}{_NO_UNIT}")
_POSTCODE = re.compile(r"[^\S\r\n]*,?[^\S\r\n]*(?:in[^\S\r\n]+)?(?:D-|A-|CH-)?\d{4,5}[^\S\r\n]+[A-ZÄÖÜ]")
_LIVES = re.compile(r"(?:wohnt|wohnhaft|wohnend|wohnte|Adresse|Anschrift|Wohnort|zieht|gemeldet)[^.\r\n]{0,25}\Z")
_ROAD = re.compile(rf"(?<![{_UP}{_LOW}\d])\d{{1,4}}[A-Za-z]?,?[^\S\r\n]+(?:[{_UP}][{_UP}{_LOW}.'’-]*[^\S\r\n]+){{1,3}}\Z")
_VOIE = re.compile(rf"(?<![{_LOW}\d])\d{{1,4}}(?:[^\S\r\n]?(?:bis|ter))?,?[^\S\r\n]+\Z")
_VOIE_TAIL = re.compile(rf"(?:(?:de|du|des|la|le|les|d'|l')[^\S\r\n]*)*[{_UP}][{_UP}{_LOW}'’-]+(?:[^\S\r\n-]+(?:(?:de|du|des|la)[^\S\r\n]+)?[{_UP}][{_LOW}'’-]+)*")
# Capitalised words that follow a word for a person and are no name.
_NO_NAME_WORDS = frozenset("Zustand Kontrolle Befund Klinik Klinikum Abteilung Station Anamnese Datum Untersuchung Aufnahme Institut Praxis Zentrum Hospital Department Clinic History Report Number Name Nr ID Alter Geburtsdatum Nummer Unbekannt Siehe Keine Nicht Kein Telefon Tel Mobil Fax E-Mail Email Mail Uhr Montag Dienstag Mittwoch Donnerstag Freitag Bitte Termin Terminvereinbarung Rückruf Anmeldung Auskunft Zentrale Sekretariat Ambulanz Pforte Büro Notruf Please Appointment Office Desk".split())


def iban_ok(value: str) -> bool:
    """Whether an account number has the length and check digits of an IBAN."""
    v = value.replace(" ", "")
    return 15 <= len(v) <= 34 and int("".join(str(int(c, 36)) for c in v[4:] + v[:4])) % 97 == 1


def _name_like(v: str) -> bool:
    return not any(w in _NO_NAME_WORDS for w in re.split(r"[\s,]+", v))


def _announced(text: str, kind: str, start: int, end: int) -> Iterator[tuple[int, int, str]]:
    """What an anchor of a kind that stands for itself tells, by parsers of its surroundings."""
    if kind == "line":
        if start and text[start - 1].isalpha():
            return
        m = _LINE.match(text, end)
        if m:
            yield *m.span("p"), "phone"
    elif kind in ("plus", "zeros"):
        m = (_PLUS if kind == "plus" else _ZEROS).match(text, start)
        inside = start and (text[start - 1].isalnum() or text[start - 1] in "+.,-/" or (start > 1 and text[start - 1] == " " and text[start - 2].isdigit()))
        if m and not inside and 9 <= sum(c.isdigit() for c in m.group()) <= 16:
            yield *m.span(), "phone"
            lo = max(0, start - 80)
            n = _BEFORE_PHONE.search(text[lo:start])
            if n and _name_like(n.group("n")):
                a, b = n.span("n")
                first = text[lo + a : lo + b].split()[0]
                if first not in _NO_NAMES:
                    yield lo + a, lo + b, "name"
    elif kind == "role":
        if start and text[start - 1].isalpha():
            return
        m = _AFTER_ROLE.match(text, end)
        if m is None and text[start:end] == "Patient":
            m = _AFTER_PATIENT.match(text, end)
        if m and _name_like(m.group("n")):
            yield *m.span("n"), "name"
    elif kind == "form":
        m = None if start and text[start - 1].isalpha() else _FORM_PARSERS[text[start:end]].match(text, start)
        if m and _name_like(m.group("n")) and m.group("n").split()[0] not in _NO_NAMES:
            yield *m.span("n"), "name"
    elif kind == "number":
        m = _LABELLED.match(text, end)
        if m:
            yield *m.span("i"), "id_number"
    elif kind in ("street", "place"):
        tail = _STREET_TAIL.match(text, end)
        if tail:
            lo = max(0, start - 60)
            head = _STREET_HEAD.search(text, lo, start)
            a = head.start()
            word = text[a:end]
            if word[:1].isupper() and len(word) > 4 and (kind == "street" or _POSTCODE.match(text, tail.end()) or _LIVES.search(text, max(0, a - 60), a)):
                yield a, tail.end(), "street"
    elif kind == "road":
        head = _ROAD.search(text, max(0, start - 60), start)
        if head and not text[end : end + 1].isalpha():
            yield head.start(), end, "street"
    elif kind == "voie":
        head, tail = _VOIE.search(text, max(0, start - 12), start), _VOIE_TAIL.match(text, end)
        if head and tail:
            yield head.start(), tail.end(), "street"
    elif kind == "iban":
        m = _IBAN.match(text, start)
        while m:  # the longest part that the check digits confirm
            v = m.group()
            if iban_ok(v):
                yield m.start(), m.start() + len(v), "id_number"
                return
            cut_ = v.rpartition(" ")[0]
            if len(cut_) < 15:
                return
            m = re.compile(re.escape(cut_)).match(text, start)


_TYPES = {"n": "name", "p": "phone", "i": "id_number", "s": "street"}
_AT = ("@", "(at)", "[at]", "( at )", "[ at ]")
# Words that no name begins with.
_NO_NAMES = frozenset("Der Die Das Ein Eine Laut Für Bei Nach Am Im In Es Z Kein Keine Befund Dr Prof Hr Fr Herr Herrn Frau Mr Mrs Ms Mme PD OA OÄ Pat Patient Patientin".split())


def _form(word: str) -> re.Pattern:
    """A form of address with the titles and the name behind it."""
    return _p(rf"{re.escape(word)}{{s}}+{{T}}(?P<n>{{N}})".replace("{s}", r"[^\S\r\n]"), True)


#: Anchor: kinds that announce themselves.
_KINDS: dict[str, list[str]] = {}
for _kind, _words in (("line", _LINES), ("number", _NUMBERS), ("street", _STREETS), ("place", _PLACES), ("road", _ROADS), ("voie", _VOIES), ("role", _ROLES.split("|")), ("plus", ("+",)), ("zeros", ("00",)), ("iban", ("DE", "AT", "CH", "FR", "GB", "NL"))):
    for _word in _words:
        _KINDS.setdefault(_word, []).append(_kind)
for _word in _FORMS:
    _KINDS.setdefault(_word, []).append("form")
_FORM_PARSERS = {w: _form(w) for w in _FORMS}


def _automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for w in {*_AHEAD, *_BEHIND, *_AT, *_KINDS}:
        a.add_word(w, (len(w), tuple(_AHEAD.get(w, ())), tuple(_BEHIND.get(w, ())), w in _AT, tuple(_KINDS.get(w, ()))))
    a.make_automaton()
    return a


_ANCHORS = _automaton()


def mentions(text: str) -> list[tuple[int, int, str]]:
    """``(begin, end, type)`` of each mention, in order and without overlaps.

    Of overlapping finds the longest counts, of equals the first found.
    """
    found: dict[tuple[int, int], str] = {}

    def take(m: re.Match, base: int = 0) -> None:
        for g, v in m.groupdict().items():
            if v is not None:
                kind = _TYPES[g[0]]
                a, b = m.span(g)
                if kind == "phone":
                    digits = sum(c.isdigit() for c in v)
                    if digits < 5 or digits > 16:
                        continue
                elif kind == "name" and v.split()[0] in _NO_NAMES:
                    continue
                elif kind == "id_number" and sum(c.isdigit() for c in v) < 4:
                    continue
                found.setdefault((a + base, b + base), kind)

    told: dict[tuple[int, int], str] = {}
    for last, (n, ahead, behind, at, kinds) in _ANCHORS.iter(text):
        start = last - n + 1
        for kind in kinds:
            for a, b, k in _announced(text, kind, start, last + 1):
                told.setdefault((a, b), k)
        if at:
            lo = max(0, start - 80)
            m = _LOCAL.search(text, lo, start)
            m = _EMAIL.match(text, m.start()) if m else None
            if m:
                begin = m.start()
                found.setdefault((begin, m.end()), "email")
            continue
        for p in ahead:
            m = p.match(text, start)
            if m:
                take(m)
                break
        for p in behind:
            lo = max(0, start - REACH)
            m = p.search(text[lo:start])
            if m:
                take(m, lo)
                break
    # what a cue says comes first: announced mentions fill the places that are left
    out = _apart(found)
    if told:
        out = _apart({k: v for k, v in told.items() if not _meets(out, *k)}, out)
    return out


def _meets(spans: list[tuple[int, int, str]], a: int, b: int) -> bool:
    """Whether [a, b) overlaps one of the spans, which are sorted and apart."""
    i = bisect_right(spans, (b,))
    return i > 0 and spans[i - 1][1] > a


def _apart(found: dict[tuple[int, int], str], given: list[tuple[int, int, str]] | None = None) -> list[tuple[int, int, str]]:
    """The given spans and of the found ones the longest of those that overlap, sorted."""
    out = list(given or ())
    for (a, b), k in sorted(found.items(), key=lambda x: (x[0][0] - x[0][1], x[0])):
        if not _meets(out, a, b):
            insort(out, (a, b, k))
    return out


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows: list[int] = []
        lo: list[int] = []
        hi: list[int] = []
        kinds: list[str] = []
        for i, t in enumerate(b.column("text").to_pylist()):
            for x, y, k in mentions(t):
                rows.append(i)
                lo.append(x)
                hi.append(y)
                kinds.append(k)
        at = pa.array(rows, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [b.column("table_name").take(at), b.column("row_id").take(at), pa.array(lo, pa.int32()), pa.array(hi, pa.int32()), pa.array(kinds, pa.string())],
            ["table_name", "row_id", "begin_pos", "end_pos", "pii_type"],
        )


def _redact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts, counts = [], []
        for t in b.column("text").to_pylist():
            parts, at, n = [], 0, 0
            for x, y, k in mentions(t) if t else ():
                parts += [t[at:x], PLACEHOLDERS[k]]
                at, n = y, n + 1
            texts.append(t if not n else "".join(parts) + t[at:])
            counts.append(n)
        yield pa.RecordBatch.from_arrays([b.column("table_name"), b.column("row_id"), pa.array(texts, pa.string()), pa.array(counts, pa.int32())], ["table_name", "row_id", "redacted", "n_mentions"])


def texts_of(*tables: tuple[DataFrame, str, str, str]) -> DataFrame:
    """``(table_name, row_id, text)`` of several tables, given as (table, name, key, text column)."""
    out = None
    for df, name, key, text in tables:
        part = df.select(F.lit(name).alias("table_name"), F.col(key).cast("bigint").alias("row_id"), F.col(text).alias("text"))
        out = part if out is None else out.unionAll(part)
    return out


def _has_text(c: Column) -> Column:
    return c.isNotNull() & (F.length(c) > 0)


def find_mentions(texts: DataFrame) -> DataFrame:
    """``(table_name, row_id, begin_pos, end_pos, pii_type)`` of every mention.

    Null and empty texts have none; a repeated row gives its mentions again; an
    empty table gives an empty result.
    """
    return texts.where(_has_text(F.col("text"))).mapInArrow(_scan, "table_name string, row_id bigint, begin_pos int, end_pos int, pii_type string")


def redact(texts: DataFrame) -> DataFrame:
    """``(table_name, row_id, redacted, n_mentions)``: every row, with typed
    placeholders for its mentions and all else unchanged; null stays null."""
    return texts.mapInArrow(_redact, "table_name string, row_id bigint, redacted string, n_mentions int")
