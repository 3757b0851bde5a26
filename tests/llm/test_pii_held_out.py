"""Personal information in sentences the training table has nothing of: other words, names, roads, towns, domains and numbers."""

import re

import pytest

from sparkshoal.llm import pii, pii_table

# In brackets what is to be found, after its kind's first letter: person, email, telephone, identity number, address.
SENTENCES = """
p[Margaret Thompson] will present the quarterly figures on Thursday.
Our landlord p[John Smith] fixed the boiler yesterday.
I met p[Jean Dupont] in the lobby of the embassy.
The keynote by p[Rebecca Stone-Gallagher] was excellent.
p[A. Whitfield] and p[Gordon P. Hargreaves] co-signed the lease.
Witness statement of p[Siobhan O'Connell], taken in the afternoon.
Coach p[Terrence Blackwood] was furious with the referee.
The violin belonged to p[Hannelore Zimmermann] once.
p[FIONA MACALLISTER] HAS LEFT THE BUILDING
Deliveries are handled by p[Okonkwo, Chidi] at the gate.
Therapist: p[Rosalind Achterberg]
Your nurse today is p[Benedict Umunna].
Thank you, p[Gwendolyn Farquhar], for everything.
p[Hiroshi Tanaka] repaired the piano in one morning.
The librarian, p[Dolores Quintanilla], was not amused.
Ask p[Nikolai Petrenko] where the ladder is.
Frau p[Annegret Schwarzkopf] gießt die Blumen.
Den Kuchen hat p[Wolfgang Eisenhauer] gebacken.
p[Jürgen Müller] kommt um acht Uhr vorbei.
Laut p[Friedhelm Nussbaum] fällt der Unterricht aus.
Le jardin de p[Solange Beauchamp] est magnifique.
p[Thierry Vasseur] répare les vélos du quartier.
Merci à p[Gérard Lacombe] pour le dîner.
El perro de p[Inmaculada Barrios] ladra mucho.
p[Ramiro Echeverría] toca la guitarra los domingos.
Gracias a p[Consuelo Villanueva] tenemos entradas.
Drop a line to e[margaret.t@blueheron-books.com] and we will reply.
Newsletter problems: e[help@northpolecycles.co.uk]
e[jdupont77@laposte-exemple.fr] bounced this morning.
reach him under e[r.echeverria [at] museo [dot] es]
The invoice was mailed to e[accounts.payable@harlow-and-sons.net] twice.
Rückfragen an e[w.eisenhauer@backstube-muster.de] bitte.
Para dudas, e[biblioteca@ayto-ejemplo.es].
If the alarm rings, phone t[(415) 867-5309] at once.
The vet's number is t[020 7946 0958].
Text t[+1 312 664 2201] for a table.
You can call t[01632 960777] during office hours.
Mein Handy: t[0171 5554321]
Erreichbar unter t[+49 89 4455 6677] bis fünf.
La pharmacie répond au t[04 78 33 21 90] le matin.
Teléfono de la clínica: t[91 538 42 07]
Llámame al t[655 120 934] cuando salgas.
Fax machine on t[212-736-5000].
The nanny's mobile is t[07912 345678].
Her social security number, i[219-09-9999], was on the form.
Applicant's SSN: i[457-55-5462]
His national insurance number is i[JG103759A].
Passport number i[C03005988] has expired.
passport i[533380006] issued abroad
Steuer-ID i[86 095 742 719]
Personalausweis i[L8988901C] liegt im Tresor.
Voici mon numéro de sécurité sociale, i[2 69 05 49 588 157 80]
Mi DNI es i[53172846H] y no lo encuentro.
NIE i[X2482300W]
They relocated to a[221 Baker Street, London] in autumn.
Visit us at a[742 Evergreen Terrace, Springfield] any day.
Parcels for a[Flat 3, 18 Wellington Road] go to the porter.
He bought a[1600 Amphitheatre Parkway] as an investment.
Return address: a[5 Primrose Hill, Bath BA2 4PF]
Sie zog in die a[Goethestraße 12, 60313 Frankfurt].
Büro: a[Am Markt 7, 28195 Bremen]
Il habite a[14 rue de la Fontaine, 75016 Paris].
Adresse : a[8 bis avenue des Tilleuls]
Viven en a[Calle de Alcalá 48, 28014 Madrid].
La oficina: a[Paseo de Gracia 92]
The recipe needs flour, 200 g of sugar and two eggs.
Chapter 14 covers the Thirty Years War and its causes.
Mount Everest and Lake Victoria are on the map.
HMS Northern Star anchored off Cape Horn at 06:45.
Invoice 2024-00871 was paid in April.
Our Wi-Fi router runs firmware 3.14.159 since Monday.
The Grand Budapest Hotel has 42 rooms and a lift.
Gadus morhua and Homarus gammarus are on the menu.
Please reset the counter to 00000 and restart.
Platform 9 King's Cross, track 4, coach 12.
The Finance Department and the Sales Team share a printer.
See RFC 2822 and ISO 8601 for the format.
Order number 880-4451-2290 ships from Rotterdam.
Barcode 4006381333931 is a highlighter.
Der Zug nach Bad Oldesloe hat zwanzig Minuten Verspätung.
Le Palais Royal est fermé le lundi et le mardi.
La Sagrada Familia recibe miles de visitas.
ALL STAFF MUST WEAR GREEN HELMETS INSIDE THE PLANT
Version 10.0.19045 introduced the bug, 10.0.19046 fixed it.
Commit 4f2a9c17 reverted the change from 91be02d4.
tweet from @nasa_news about the launch
Temperature fell from 21.5 to 17.8 degrees on 2024-03-11.
""".strip().splitlines()

KIND = {"p": "person_name", "e": "email", "t": "phone", "i": "id_number", "a": "address"}
MARKED = re.compile(r"(?<!\w)([petia])\[((?:[^\[\]]|\[(?:at|dot)\])+)\]")


def parsed():
    for line in SENTENCES:
        text, spans, at = "", [], 0
        for m in MARKED.finditer(line):
            text += line[at : m.start()]
            spans.append((len(text), len(text) + len(m.group(2)), KIND[m.group(1)]))
            text += m.group(2)
            at = m.end()
        yield text + line[at:], spans


@pytest.fixture(scope="module")
def outcome():
    texts, gold = zip(*parsed())
    found = pii.Tagger(pii.train()).texts(list(texts))
    return texts, [{(a, k) for a, _, k in g} for g in gold], [{(a, k) for a, _, k in f} for f in found]


def test_nothing_of_it_is_in_the_training_table():
    known = {w for t in [*pii_table.GIVEN, *pii_table.FAMILY] for w in [t]}
    for text, spans in parsed():
        for a, b, kind in spans:
            if kind == "person_name":
                assert not set(re.findall(r"[^\W\d_]{3,}", text[a:b])) & known, text
    templates = {re.sub(r"\{\w+\}|\W", "", t).lower() for table in (pii_table.HELD, pii_table.FREE) for ts in table.values() for t in ts}
    assert not templates & {re.sub(r"\W", "", MARKED.sub("", line)).lower() for line in SENTENCES if len(MARKED.sub("", line)) > 15}


def test_recall_and_precision_on_other_words(outcome):
    texts, gold, found = outcome
    hits, there, given = sum(len(g & f) for g, f in zip(gold, found)), sum(map(len, gold)), sum(map(len, found))
    wrong = [(t, sorted(g ^ f)) for t, g, f in zip(texts, gold, found) if g != f]
    assert hits / there >= 0.9 and hits / given >= 0.9, (hits, there, given, wrong)
