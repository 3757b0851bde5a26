"""Small labelled table the personal-information model is trained on.

Everyday sentences (offices, shops, clinics, schools, travel, software) with
slots; a slot's kind is the label of what fills it. Names, roads and towns are
half common ones, half words made up anew each time, so that the model learns
forms and surroundings and no list. Numbers follow public numbering plans and
the published forms of identity documents. Nothing here is taken from the texts
the model is applied to. Everything is drawn from a fixed seed, so the table,
and the model, are the same everywhere. In number forms ``#`` stands for a
digit, ``@`` for a capital letter.
"""

from __future__ import annotations

import random
import re

GIVEN = "James Mary Robert Patricia Peter Jennifer Michael Linda David Elizabeth William Barbara Susan Thomas Sarah Karen Daniel Nancy Laura Kevin Emma Olivia Lukas Anna Stefan Sabine Klaus Monika Dieter Heike Ulrike Matthias Pierre Camille Julien Nathalie Antoine Isabelle Hugo Chloé Carlos Carmen Javier Lucía Miguel Pilar Diego Elena Mehmet Aisha Yuki Wei Priya Olga Ivan Fatima Kofi Ingrid Søren Zoë".split()
FAMILY = "Johnson Williams Brown Jones Miller Davis Wilson Taylor Anderson White Harris Clark Lewis Walker Hall Young King Wright Baker Schmidt Schneider Fischer Weber Wagner Becker Hoffmann Koch Bauer Richter Martin Bernard Petit Durand Leroy Moreau Laurent Lefebvre Girard Hernández González Rodríguez Fernández Martínez Sánchez Pérez Ruiz Torres Kowalski Novak Ivanov Rossi Nakamura Chen Khan Singh Nguyen Okafor Haddad Larsen".split()
PARTICLE = ["van", "von", "de", "de la", "van der", "da", "di", "al", "zu"]
#: Kinds of natural and built places, as geographical dictionaries list them.
GEO = "Bank Bar Basin Bay Beach Bend Bight Bluff Bridge Brook Canyon Cape Castle Cave Channel Cliff Coast Cove Creek Crossing Dale Deep Delta Desert Dock Dunes Estuary Falls Fan Farm Fell Field Firth Fjord Flat Flats Ford Forest Gap Garden Gate Glacier Glen Gorge Grove Gulf Harbor Harbour Haven Head Heath Heights Hill Hills Hole Hollow Inlet Island Islands Isle Junction Key Knoll Lagoon Lake Landing Ledge Lighthouse Loch Marina Marsh Meadow Mill Moor Mount Mountain Mouth Narrows Ness Oasis Park Pass Passage Peak Peninsula Pier Pinnacle Plain Plateau Point Pond Pool Port Quarry Quay Range Rapids Ravine Reach Reef Reserve Ridge Rise River Roads Rock Rocks Sand Sands Sea Seamount Shelf Shoal Shoals Shore Sill Slope Sound Spit Spring Spur Station Strait Stream Summit Swamp Terrace Tower Trail Trench Trough Tunnel Valley Village Volcano Wall Waterfall Well Wharf Woods Bucht Insel Hafen Grund Riff Tal Berg See Turm Platz".split()
ROAD_KIND = ["Street", "St", "St.", "Road", "Rd", "Rd.", "Avenue", "Ave", "Ave.", "Lane", "Ln", "Drive", "Dr.", "Close", "Court", "Place", "Square", "Terrace", "Crescent", "Way", "Row", "Hill", "Gardens", "Grove", "Walk", "Mews", "Boulevard", "Blvd", "Parkway"]
ROAD_ABROAD = ["rue", "avenue", "boulevard", "quai", "impasse", "allée", "chemin", "calle", "avda", "avenida", "paseo", "ronda", "travesía", "straße", "weg", "gasse", "allee"]
ROAD_NAME = ["Church", "High", "Mill", "Station", "Park", "Victoria", "Queen", "Elm", "Maple", "North", "Second", "Market", "Bridge", "School", "Castle", "Old Mill", "Oak Tree", "Green", "Abbey", "Cedar"]
TITLE = ["Dr", "Dr.", "Mr", "Mr.", "Mrs", "Mrs.", "Ms", "Prof.", "Professor", "Captain", "Sir", "Madam"]
ROLE = "Vice President,General Manager,Senior Analyst,Head Nurse,Chief Engineer,Project Lead,Night Porter,Sales Team,Customer Service,Board Member,First Officer,Software Architect,Deputy Mayor,Head Coach,Data Team,Site Manager,Human Resources,Quality Assurance,Second Mate,Team Leader,Safety Officer,Duty Officer,Research Fellow".split(",")
ORG = "Institute,University,Company,Bakery,Museum,Bank,Airlines,Group,Holdings,Hospital,Society,Club,Foundation,Press,Library,Hotel,Theatre,Orchestra,Council,Systems,Party,Crew,Squad,Project,Expedition,Survey,Academy,Agency".split(",")
SHIP = ["RV", "MV", "SS", "HMS", "MS", "USS", "FS", "R/V", "M/V", "the ship", "the ferry", "the yacht", "vessel", "tug"]
LATIN = ["us", "a", "um", "is", "ensis", "ata", "ii", "oides", "idae", "ops", "ella", "ia", "aria", "morpha"]

PHONE = {
    "en": ["07### ######", "07###-######", "07### ### ###", "07#########", "020 #### ####", "0### ### ####", "0#### ######", "(0##) #### ####", "+44 7### ######", "+44 7### ### ###", "+44 20 #### ####", "+44 (0)20 #### ####", "0044 7### ### ###", "0044 20 #### ####", "(###) ###-####", "###-###-####", "###.###.####", "### ### ####", "+1 ### ### ####", "+1-###-###-####", "+1 (###) ###-####", "+1 (###) ### ####", "1-800-###-####", "###–###–####", "0 7 # # # # # # # ###", "+## ### #######", "+###########", "+### ## ### ####", "+### ### ## ## ##", "(+###) ### ## ## ##", "+###-###-######", "+### ### ######", "00### ### ## ## ##"],
    "de": ["030 #######", "030/#######", "030/########", "030 ########", "0###/########", "030 - ##### ##", "030 - ##### ###", "0### #######", "0###/######", "0###/#####-##", "0###-#######", "0#### ######", "+49 30 #######", "+49 30 ##### ###", "+49 ### #######", "+49 (0)### ######", "+49 (0)30 #####-###", "0049 ### #######", "030 ##### ###", "(0###) ######"],
    "fr": ["0# ## ## ## ##", "0#.##.##.##.##", "0#-##-##-##-##", "0#########", "0### ######", "+33 # ## ## ## ##", "+33 (0)# ## ## ## ##", "0033 # ## ## ## ##", "+33 ### ## ## ##", "+33#########"],
    "es": ["6## ### ###", "6## ## ## ##", "9## ### ###", "9## ## ## ##", "+34 6## ### ###", "+34 ### ## ## ##", "0034 9## ### ###", "+34-###-######", "+34 ### ######", "6########", "(+34) 9## ## ## ##"],
}
#: Forms of identity numbers as the issuing states publish them.
ID = {
    "en": ["###-##-####", "### ## ####", "#########", "@@######@", "@@ ## ## ## @", "@@ ######@", "@########", "#########", "@@#######", "@## ### ####", "@# ### ####", "@#######"],
    "de": ["## ### ### ###", "###########", "@@@######", "@########", "@##@##@##", "@## @## @##", "@## @## @ ##", "@#@######", "###########", "@##@###@##", "@## ##@# @ ##", "## ###### @ ###"],
    "fr": ["# ## ## ## ### ### ##", "# ## ## ## ### ###", "#############", "###############", "##@@#####", "## @@ #####", "############"],
    "es": ["########@", "########-@", "##.###.###-@", "##.###.###@", "@#######@", "@-#######-@", "@@@######", "@@@ ######", "@@@-######", "## ### ### @"],
}
#: Things that are numbered and are not people.
RECORD = "order,invoice,serial,catalogue,key,record,item,part,product,article,stock,batch,lot,sample,specimen,accession,reference,file,case,docket,parcel,tracking,consignment,account,meter,ticket,coupon,voucher,licence key,barcode,asset,tag,label,model,device,unit,shelf mark,plate,locker,box,page,row,bin,drawer,cell,token,print run,build,release,patch,board,rig,sensor,lamp,spare part,Bestellung,Artikel,Seriennummer,Akte,Gerät,Teil,commande,article,dossier,appareil,pièce,pedido,artículo,expediente,aparato,pieza".split(",")
DOMAIN_END = ["com", "org", "net", "de", "fr", "es", "co.uk", "edu", "io", "example", "test", "invalid", "example.com", "info", "eu"]
AT = ["@"] * 7 + ["＠", " [at] ", " (at) ", "[at]", "(at)", " @ "]
DOT = ["."] * 7 + [" [dot] ", " (dot) ", "[dot]", " dot "]
MONTH = "January February March April May June July August September October November December Mon Tue Monday Friday Januar März avril mayo".split()

HELD = {
    "en": [
        "{name} chaired the meeting.", "The minutes were taken by {name}.", "Please forward this to {name} before noon.", "Dear {name},", "Kind regards, {name}", "Attendees: {name}, {name} and {name}.", "Patient: {name}.", "{title} {name} teaches chemistry here.", "I spoke with {name} about the invoice.", "{name} was born in {town}.", "Interview with {name}", "The prize went to {name} of {town}.", "contact person: {name}", "author = {name}", "author = {name}; version = #", "Written by {name} on {date}.", "{title} {name} called this morning.", "copy to {name}, front desk", "{name} wrote:", "When {name} left the company the shop closed.", "Many thanks to {name} for the cake!", "driver {name}, passenger none", "Nurse on duty: {name}.", "{name} and {name} agreed on the price.", "{name}, {role}", "{role}: {name}", "Ask {title} {name} or {name}.", "approved: {name} / budget: closed", "It was {name} who found the keys.", "We heard from {name} that the train is late.", "Tickets for {name} are at the till.", "{name} said that the soup was cold.", "My teacher, {name}, doubts it.", "Give the book back to {name}, please.", "Questions go to {name}.", "This photo is by {name}.", "Best, {name}", "Yours sincerely, {name}", "{title} {name} and {title} {name} were late.", "A letter by {name} arrived, then {name} rang.", "{name} helped, and so did the staff.", "Room booked, {name} and the guests came.", "name: {name}",
        "Write to {email} for tickets.", "Mail {email}.", "Questions? Contact <{email}> today.", "No answer from {email}, ask again", "({email}) runs the shop.", "e-mail: {email}", "link mailto:{email}", "login={email}", "user={email} was locked.", "Please send the bill to {email}.", "From: {email}", "cc {email}; subject: rent",
        "Call {phone} after six.", "My number is {phone}.", "Ring me on {phone}, not before nine.", "{phone} (ask for the manager)", "text {phone} when you arrive", "mobile {phone}", "Phone: {phone}", "fax {phone};", "tel {phone}", "Hotline {phone}, press two.", "You can reach the plumber at {phone}.", "home phone {phone}", "WhatsApp {phone}", "Emergency contact: {phone}.", "cell: {phone}",
        "Social security number {id}.", "SSN {id}", "ssn = {id}", "His SSN is {id}, keep it safe.", "Passport no. {id}", "passport {id} was stolen", "The visa is for passport number {id}.", "national insurance number {id}", "NI number: {id}", "Tax ID {id} belongs to the tenant.", "Driving licence {id} is no longer valid.", "ID card {id}", "identity card number {id} was copied.", "identity document {id} / nationality unknown", "Please quote {id}, your personal identity number.", "Tenant with national id {id} signed.", "Insurance file, national insurance {id}, closed.", "My passport, {id}, expires in {month}.", "{id} is the number on the passport.", "{id} is my social security number.", "identity number {id}",
        "We moved to {addr}.", "Deliver to {addr}.", "Address: {addr}", "She lives at {addr}.", "The parcel went to {addr}, second floor.", "Postal address {addr}.", "Send the keys back to {addr} by Friday.", "Our shop is at {addr}.", "Meet us at {addr} at noon.", "Billing address: {addr}.", "House for sale: {addr}", "The taxi waits at {addr}.",
    ],
    "de": [
        "{name} leitet die Sitzung.", "Protokoll von {name}.", "Bitte an {name} weiterleiten.", "Herr {name} kommt später.", "Frau {name} ist heute nicht da.", "Sehr geehrte Frau {name},", "Sehr geehrter Herr {name},", "Mit freundlichen Grüßen {name}", "Nach Ansicht von {name} ist der Preis zu hoch.", "Ansprechpartner: {name}", "Das Foto hat {name} gemacht.", "Gestern rief {name} an, der Zug war weg.", "Die Rechnung bezahlt {name}.", "{name} meint, die Suppe sei kalt.", "Unterschrift: {name}", "Fahrer war {name}, es regnete.",
        "Bitte eine Mail an {email} senden.", "Mail: {email}", "Fragen an {email}.", "Kontakt: {email}", "Rufen Sie {phone} an.", "Telefon {phone}", "Telefon: {phone}", "Mobil {phone}", "Tel {phone}", "Fax: {phone}", "Unter {phone} erreichen Sie die Praxis.", "Abends bitte {phone} wählen.", "{Words} {phone} anrufen.", "Vorher {phone} anrufen.",
        "Steuernummer {id}", "Die Steuer-Identifikationsnummer lautet {id}.", "Steuer-ID: {id}", "Ausweis {id} ist abgelaufen.", "Personalausweis Nr. {id}", "Reisepass Nr. {id}", "Reisepass {id} wurde gestohlen.", "Passnummer {id}", "Sozialversicherungsnummer {id}", "Ausweisnummer: {id}",
        "Adresse: {addr}.", "Wohnhaft in {addr}.", "Das Paket geht nach {addr}.", "Wir wohnen {addr}.", "Lieferung an {addr}.", "Unser Laden: {addr}", "Die Praxis ist {addr}.", "Rücksendung bitte an {addr}.",
    ],
    "fr": [
        "{name} préside la réunion.", "M. {name} arrive demain.", "Mme {name} est absente.", "Chère {name},", "D'après {name} le prix est trop haut.", "Compte rendu de {name}.", "Cordialement, {name}", "Contact : {name}", "La photo est de {name}.", "{name} pense que la soupe est froide.", "Le train de {name} est parti ce soir.", "Voiture conduite par {name}, il pleuvait.", "signature : {name}",
        "Écrire à {email}.", "Adresse mail : {email}", "Merci d'envoyer la facture à {email}.", "mél : {email}", "Téléphone {phone}", "Téléphone : {phone}", "Tél : {phone}", "Portable {phone}", "Appelez le {phone} après midi.", "Joindre le cabinet au {phone}.", "fax {phone}",
        "Numéro de sécurité sociale {id}", "Sécurité sociale : {id}", "N° INSEE {id}", "Carte d'identité {id}", "Passeport {id}", "Numéro de passeport {id}.", "Le passeport n° {id} a été volé.", "Carte vitale n° {id}",
        "Adresse postale : {addr}.", "Nous habitons {addr}.", "Le colis part pour {addr}.", "Livraison au {addr}.", "Rendez-vous au {addr}.", "Le magasin est {addr}.",
    ],
    "es": [
        "{name} preside la reunión.", "El señor {name} llega mañana.", "La señora {name} no está.", "Estimada {name}:", "Para {name} el precio es alto.", "Acta de {name}.", "Saludos, {name}", "Contacto: {name}", "La foto es de {name}.", "{name} cree que la sopa está fría.", "Conducía {name}, llovía.", "Firma: {name}", "El doctor {name} y la doctora {name} vienen.", "Sr. {name}", "Según dice {name}, no hay tren.",
        "Escriba a {email}.", "Correo electrónico: {email}", "Envíe la factura a {email}.", "Teléfono: {phone}", "Tel. {phone}", "Móvil {phone}", "Llame al {phone} por la tarde.", "Puede llamar al {phone}.", "fax: {phone}",
        "DNI n.º {id}", "DNI: {id}", "Mi DNI es {id}.", "NIE {id}", "NIF {id}", "Pasaporte n.º {id}", "Pasaporte: {id}", "El pasaporte {id} fue robado.", "Número de identidad {id}",
        "Dirección: {addr}.", "Vivimos en {addr}.", "El paquete va a {addr}.", "Entrega en {addr}.", "Nos vemos en {addr}.", "La tienda está en {addr}.",
    ],
}
FREE = {
    "en": [
        "The bus to {place} leaves at {time} from bay ##.", "We walked from {place} to {place} in ## hours.", "{place} is closed on Monday and Tuesday.", "{place} and {place} are both worth a visit.", "Flight @@#### to {cap} was late by ## minutes.", "{ship} {cap} {Word} sailed from {place} at {time}.", "{ship} {Word} {Word} reached {place}.", "{binomial} grows near {place} in spring.", "{binomial} or {binomial}, the gardener could not say.", "{Binomial} is a protected plant, says the sign.", "The {role} and the {role} met the {Word} {org}.", "{role} and {role} came to lunch with {org} {Word}.", "{Word} {org} won ## to # against {cap} {org}.", "The {org} of {cap} opened in ####.", "Invoice {code} corrects invoice {code} of {date}.", "Order {code} was sent in ## boxes.", "Order number {digits} is in aisle ##.", "Part no. {digits} fits the old pump.", "Serial number {digits} is printed inside the lid.", "Serial no. {code}, type {code}.", "Ticket {code} is still open.", "Ticket no. {digits} was closed.", "ISBN {digits} is out of print.", "Version {version} solves {digits} complaints.", "Driver {version}, kernel {version}, browser {version}.", "{version} runs, {version} does not.", "See {hash} and {hash}.", "checksum {hash}, size {digits}", "Parcel {code} weighs ## kg.", "Lot {code} sold for {digits} pounds.", "Shelf mark {digits} is on loan.", "Blood sample {digits} is in the fridge.", "Item {digits} was returned.", "Meter reading {digits} on {date}.", "Account {digits} is in the red.", "Key {digits} opens the garage.", "{digits} comes before {digits}.", "{code} to {code} are sold out.", "GPS ##.####, -##.####, height #### m.", "Coordinates ##° ##' N, ##° ##' W.", "It measures ##.# cm by ##.# cm, tolerance ###-#### nm.", *["{Word} ## {place}, {word} ##, {word} ####.", "{word} # {place}, {word} ###"] * 5, *["{Words} {word} ##, {road} ###.", "{Words} {word} ##, {road} ###-####.", "{Words} {road} {words}, # {road}s.", "{Record} ##, {road} ##, {word} #."] * 4, "Platform ## {place}, track ##, coach ##.", "Row ## {place}, seat ####.", "Exit # {place}, junction ##.", "Write to @{word} or @{word}-news if it fails.", "image@2x.png is missing, logo@3x.png is not", "npm install {word}@{version}", "p@0.5 was ##, p@0.##:0.## was ##", "Shares rose from ## to ## percent after {month}.", "Only ## of #### tickets were sold for {place}.", "Chapter ##: {Title} {Title} and {Title}", "{Title} {Title} and {Title} {Title}", "{Title} {Title}", "{Title} {Title} {Title}", "# {word}", "## {Title} {Title}", "## {word}", "{place} {code}", "{place}, {date}", "Figure #: {Word} {word} of the {word}.", "{town}", "{town} ##### by train.", "Back to {town}, then on to {town} and {place}.", "I like {cap} better than {cap} in {month}.", "Opening hours {time} to {time}, {month} to {month}.", "{UPPER} {UPPER} {UPPER} {UPPER}", "{UPPER} {UPPER}, {UPPER} {UPPER} AND {UPPER} {UPPER} {UPPER}.", "Found by Team {Word} at {place}.", "Seen by Group Three at {place}.", "Report of the {Word} {org} on {place}, page ##.", "Due {date}, paid {date}.", "Room {code}, floor #, {place}.", "Bus ##, tram ##, line {code}.", "&nbsp;&nbsp; {salad}", "<p> {salad}", "> {salad}", "- {salad}", "Q: {salad}", "Note: {salad}", *["{salad}"] * 50, *["{Record} {number} {words}."] * 25, *["{Words} {record} {number} {words}."] * 15, *["{Record} no. {number} {words}."] * 6, *["{Record} number {number}, {record} {number}."] * 6, *["{record}: {number}"] * 4, *["{Record} {record} {number} {words}."] * 20, "{number} {words}.", "About ## of ### pupils passed.", *["{Words} ## of #### {words}.", "{cap} {words} in ## of #### {words}."] * 3, "{cap} {words} ## of ### {words}.", *["Q. {salad}", "A. {salad}", "Q. {Word} {place} {words}"] * 3, *["{Words} {hash} {words}.", "{Record} {hash} @ {word} #, {record} {code}.", "{Word} {hash} {words}, {hash}"] * 6, *["{mojibake} {words}", "{Words} {mojibake} {words}."] * 2, *["{Words} {place} {words}."] * 10, *["{Words} {cap} {words}."] * 4,
    ],
    "de": ["Der Zug nach {place} fährt um {time} ab Gleis ##.", "Die Straße bei {place} ist ## Kilometer lang.", "{cap} und {cap} liegen am Meer.", "Die Rechnung {code} berichtigt die Rechnung {code}.", "Die Karten kosten ## Euro.", "Bestellung {digits} liegt im Lager.", "Seriennummer {digits} steht im Deckel.", "Artikel {code} ist vergriffen.", "Version {version} ist neu.", "Der {role} spricht mit dem Koch.", "Das Spiel endete ## zu ##.", "Am {date} war in {place} Markt.", "Die Gemeinde {town} hat #### Einwohner.", "Offene Fragen und Termine", "Im Garten wächst {binomial}.", "Nur ## von ### Schülern waren da.", *["{cap} {words} in ## von #### {words}, {words}.", "{Words} ## {Noun} {cap} {words}.", "{Words} ## {Noun} {binomial} {words}.", "{Noun} und {Noun} {words} {Noun} ## {words}."] * 8, *["{Words} ## {Noun} {cap} {words}.", "{place} {words} ## {Noun} {binomial} {words}.", "{Words} {Noun} {Noun} {words}."] * 8, "{cap} {words} ## von #### {words}.", "{Words} bei {place} {words}.", *["{Words} {record} {number} {words}."] * 3, *["{salad}"] * 16],
    "fr": ["Le train pour {place} part à {time} du quai ##.", "La facture {code} corrige la facture {code}.", "Commande {digits} livrée le {date}.", "Le numéro de série {digits} est dans le couvercle.", "La version {version} est sortie.", "La mairie de {town} ferme à {time}.", "{cap} et {cap} sont au bord de la mer.", "Les billets coûtent ## euros.", "La route près de {place} fait ## mètres.", "Questions ouvertes et dates", "Dans le jardin pousse {binomial}.", "Seuls ## élèves sur ### sont venus.", *["{cap} {words} dans ## {words} sur ####, {words}."] * 3, "{cap} {words} ## {words} sur ####.", "{Words} de {place} {words}.", *["{Words} {record} {number} {words}."] * 3, *["{salad}"] * 14],
    "es": ["El tren a {place} sale a las {time} del andén ##.", "La factura {code} corrige la factura {code}.", "Pedido {digits} entregado el {date}.", "El número de serie {digits} está en la tapa.", "La versión {version} es nueva.", "El ayuntamiento de {town} cierra a las {time}.", "{cap} y {cap} están junto al mar.", "Las entradas cuestan ## euros.", "La carretera cerca de {place} mide ## metros.", "Preguntas abiertas y fechas", "En el jardín crece {binomial}.", "Solo ## de ### alumnos vinieron.", *["{cap} {words} en ## de #### {words}.", "{Words} en ## de ### {words}, {words}."] * 4, "{Words} de {place} {words}.", *["{Words} {record} {number} {words}."] * 3, *["{salad}"] * 14],
}
#: Words before a telephone number, and names of papers before an identity number.
CALL = {"en": ["Call", "Ring", "SMS to", "text", "dial", "phone", "mobile", "contact", "Reach us at", "my number is", "message", "hotline"], "de": ["Anruf", "SMS an", "Telefon", "Tel.", "Handy", "Ruf", "unter", "Hotline"], "fr": ["Appeler le", "Tél.", "SMS au", "portable", "joindre le", "composez le", "au", "ligne"], "es": ["Llamar al", "Tel.", "SMS al", "móvil", "llame al", "número", "marque el", "línea"]}
PAPER = {"en": ["SSN", "SSN:", "social security", "social security number", "passport", "passport number", "national insurance", "national insurance no.", "NI number", "ID card", "identity card", "identity no", "identity number", "ID number", "tax ID", "driving licence", "residence permit"], "de": ["Steuer-ID", "Steuernummer", "Personalausweis", "Ausweis", "Reisepass", "Passnummer", "Sozialversicherungsnummer", "Ausweisnummer"], "fr": ["sécurité sociale", "N° de sécurité sociale", "numéro INSEE", "carte d'identité", "passeport", "passeport n°", "numéro fiscal", "titre de séjour"], "es": ["DNI", "NIE", "NIF", "pasaporte", "pasaporte n.º", "documento de identidad", "carné", "seguridad social"]}
#: Lines of a signature or a contact list: fields, and what joins them.
FIELD, JOIN = ["name", "phone", "email", "addr"], [" | ", ", ", " | ", ", ", " / ", "; ", " - ", " · "]
#: Common words for made-up prose.
SALAD = {
    "en": "time year people way day man thing woman life child world school state family student group country problem hand part place case week company system program question work government number night point home water room mother area money story fact month lot right study book eye job word business issue side kind head house service friend father power hour game line end member law car city community team minute idea body information back parent face others level office door health person art war history party result change morning reason research girl guy moment air teacher force education run move live believe hold bring happen write provide sit stand lose pay meet include continue set learn lead understand watch follow stop create speak read allow add spend grow open walk win offer remember love consider appear buy wait serve die send expect build stay fall cut reach kill remain small large next early young important few public bad same able blue cold deep dark green loud narrow pale quiet rough soft steep thin wide was is were are has had did not but then because".split(),
    "de": "ist war sind hat haben wird kann nicht aber auch dann weil wenn sehr klein groß alt neu kalt warm rot blau schnell langsam heute gestern immer selten Haus Baum Tag Jahr Wasser Hand Wort Buch Stadt Land Tür Auge Arbeit Stunde Woche Freund Garten Fenster Straße Kind Frau Mann Schule Geld Licht Farbe Preis Brot Tisch".split(),
    "fr": "est sont était avait peut doit pas mais aussi alors parce quand très petit grand vieux neuf froid chaud rouge bleu vite aujourd hier toujours rarement maison arbre jour année eau main mot livre ville pays porte oeil travail heure semaine ami jardin fenêtre rue enfant femme homme école argent lumière couleur prix pain table".split(),
    "es": "es son era había puede debe no pero también entonces porque cuando muy pequeño grande viejo nuevo frío caliente rojo azul rápido hoy ayer siempre rara casa árbol día año agua mano palabra libro ciudad país puerta ojo trabajo hora semana amigo jardín ventana calle niño mujer hombre escuela dinero luz color precio pan mesa".split(),
}
SMALL = {"en": "the a of in to and with for from by at on under over near after that this some every two nine thirty".split(), "de": "der die das ein eine von in zu und mit für aus bei am im auf unter über nach dieser jede zwei neun".split(), "fr": "le la les un une de des du dans à et avec pour par sur sous près après ce chaque deux neuf".split(), "es": "el la los un una de del en a y con para por sobre bajo cerca tras este cada dos nueve".split()}


def _digits(r: random.Random, form: str) -> str:
    return re.sub("@", lambda _: r.choice("ABCDEFGHJKLMNPQRSTUVWXYZ"), re.sub("#", lambda _: r.choice("0123456789"), form))


def invented(r: random.Random, most: int = 2) -> str:
    """A word nobody has met: two to ``most`` syllables."""
    syllable = lambda: r.choice(["b", "br", "c", "ch", "cl", "d", "dr", "f", "fl", "g", "gl", "h", "j", "k", "kr", "l", "m", "n", "p", "ph", "pl", "qu", "r", "s", "sch", "sk", "st", "t", "th", "tr", "v", "w", "x", "y", "z", ""]) + r.choice(["a", "e", "i", "o", "u", "a", "e", "i", "o", "ae", "ea", "ie", "ou", "y", "é", "ö"][: 16 if r.random() < 0.2 else 14]) + r.choice(["", "", "", "l", "m", "n", "r", "s", "t", "x", "nd", "ll", "rk", "ck", "lm", "ng", "rt", "st"])
    return "".join(syllable() for _ in range(r.randrange(2, most + 1)))


def _cap(r: random.Random) -> str:
    return invented(r).capitalize()


def _given(r: random.Random) -> str:
    one = r.choice(GIVEN) if r.random() < 0.4 else _cap(r)
    return one + ("-" + (r.choice(GIVEN) if r.random() < 0.5 else _cap(r)) if r.random() < 0.05 else "")


def _family(r: random.Random) -> str:
    x = r.random()
    one = lambda: r.choice(FAMILY) if r.random() < 0.35 else _cap(r) + r.choice(["", "", "", "son", "berg", "man", "ez", "ski", "er", "ton", "ini", "wood"])
    if x < 0.10:
        return one() + "-" + one()
    if x < 0.13:
        return r.choice(["O'", "Mc", "Mac", "D'"]) + one()
    if x < 0.18:
        return r.choice(PARTICLE) + " " + one()
    if x < 0.22:
        return one() + " " + one()
    return one()


def _name(r: random.Random) -> str:
    given, family, x = _given(r), _family(r), r.random()
    if x < 0.15:
        return f"{given[0]}. {family}"
    if x < 0.18:
        return f"{given[0]}. {r.choice('ABCDEFGHJKLMNPRSTW')}. {family}"
    if x < 0.28:
        return f"{given} {r.choice('ABCDEFGHJKLMNPRSTW')}. {family}"
    if x < 0.33:
        return f"{given} {_given(r)} {family}"
    if x < 0.46:
        return f"{family}, {given}"
    if x < 0.60:
        return f"{given} {family}".upper()
    return f"{given} {family}"


def _ascii(word: str) -> str:
    return re.sub(r"[^a-z]", "", word.lower().split(" ")[-1].split("-")[0]) or "post"


def _email(r: random.Random) -> str:
    given, family = _ascii(_given(r)), _ascii(_family(r))
    local = r.choice([f"{given}.{family}", f"{given}-{family}", f"{given[0]}{family}", f"{family}{r.randrange(1, 2000)}", f"{given}+{_ascii(invented(r))}", f"{given}_{family[0]}".upper(), f"{given}_{family}", family, f"{given}.{family[0]}", r.choice(["info", "office", "sales", "team", r.choice(SALAD["en"]) + "." + r.choice(SALAD["en"])]), f"{given[0]}.{family}"])
    domain = _ascii(invented(r)) + r.choice(["", "", "", "mail", "-shop", "net", "-" + r.choice(SALAD["en"]), "-and-" + _ascii(invented(r))]) + "." + r.choice(DOMAIN_END)
    return local + r.choice(AT) + (r.choice(["mail.", "sub."]) if r.random() < 0.1 else "") + domain.replace(".", r.choice(DOT))


def _town(r: random.Random) -> str:
    return r.choice(["Port ", "Saint-", "Bad ", "San "] + [""] * 16) + _cap(r) + r.choice(["", "", "ton", "ham", "burg", "ville", "hausen", "wick", "mouth", "ford", "-sur-Mer", "stadt", " Ferry", " Verde", "-Noir", "field"])


def _road(r: random.Random) -> str:
    one = lambda: r.choice(ROAD_NAME) if r.random() < 0.35 else _cap(r)
    return one() + (" " + r.choice(["Park", "Hill", "Mill", one()]) if r.random() < 0.25 else "")


def _address(r: random.Random, lang: str) -> str:
    n, far = r.randrange(1, 400), r.random() < 0.6
    zip_ = _digits(r, "#####")
    gap = r.choice([", ", ", ", ", ", " "])
    if lang == "en":
        head = r.choice([""] * 5 + [f"Flat {r.randrange(1, 40)}, ", f"Unit {r.choice('ABCDE')}, ", f"Apt {r.randrange(1, 40)}, ", f"Apartment {r.randrange(1, 40)}{r.choice('AB')}, ", f"Suite {r.randrange(100, 900)}, "])
        return f"{head}{n}{r.choice(['', '', '', '', 'a', 'B'])} {_road(r)} {r.choice(ROAD_KIND)}" + (f", {_town(r)}" + r.choice(["", "", _digits(r, " @@# #@@"), _digits(r, " @## #@@"), " " + zip_, f", {r.choice(['CA', 'NY', 'TX', 'OR'])} {zip_}"]) if far else "")
    if lang == "de":
        road = r.choice([lambda: _cap(r) + r.choice(["straße", "str.", "weg", "gasse", "platz", "allee", "ring", "ufer", "damm"]), lambda: r.choice(["Am ", "An der ", "Im ", "Zum ", "Auf dem ", "Am Alten ", "Unter den "]) + _cap(r), lambda: _cap(r) + "er " + r.choice(["Straße", "Weg", "Platz", "Str."])])()
        return f"{road} {n}{r.choice(['', '', '', 'a', ' b'])}" + (f"{gap}{zip_} {_town(r)}" if far else "")
    if lang == "fr":
        road = r.choice(["rue", "avenue", "boulevard", "place", "quai", "impasse", "allée", "chemin", "cours", "Rue", "route"]) + " " + r.choice(["des ", "de la ", "du ", "de ", "de l'", ""]) + _cap(r) + r.choice(["", "", "-" + _cap(r)])
        return f"{n % 120 + 1}{r.choice(['', '', '', ' bis', ' ter', 'B'])}{r.choice([' ', ', '])}{road}" + (f"{gap}{zip_} {_town(r)}" if far else "")
    road = r.choice(["Calle", "C/", "Avda.", "Avenida", "Plaza", "Paseo", "Camino", "Ronda", "Travesía"]) + " " + r.choice(["de la ", "del ", "de las ", "de ", "", "", ""]) + _cap(r)
    return f"{road}{r.choice([' ', ', ', ', n.º ', ' nº ', ', nº '])}{n % 120 + 1}{r.choice(['', '', '', ', 2.º A'])}" + (f"{gap}{zip_} {_town(r)}" if far else "")


def _place(r: random.Random) -> str:
    first = r.choice([_cap(r), _cap(r), r.choice(SALAD["en"]).capitalize(), r.choice(GIVEN), r.choice(FAMILY)])
    x = r.random()
    if x < 0.06:
        return f"{r.choice(['Lake', 'Mount', 'Cape', 'Isle of', 'Bay of', 'Port', 'Point'])} {first}"
    return f"{r.choice(['Old', 'North', 'Great', 'Upper'])} {first} {r.choice(GEO)}" if x < 0.12 else f"{first} {r.choice(GEO)}"


def _digit_groups(r: random.Random) -> str:
    return r.choice([" ", "-", ".", "", "-", "/"]).join("".join(r.choice("0123456789") for _ in range(r.randrange(2, 6))) for _ in range(r.randrange(1, 5)))


def _code(r: random.Random) -> str:
    return _digits(r, r.choice(["@##-###", "@@####", "@@@-####", "@#### ", "@@ ## ## ##", "@@-##/####", "@###", "##@###", "@@@ ####", "@##-####", "####-##-###", "@@ ####", "@@@####-#", "#@@##"]).strip())


def _salad(r: random.Random, lang: str) -> str:
    """A made-up sentence: common and unknown words, now and then a number, a code, a name of a place or thing, a mark."""
    out: list[str] = []
    for _ in range(r.randrange(3, 14)):
        x = r.random()
        word = (
            r.choice(SMALL[lang]) if x < 0.35 else r.choice(SALAD[lang]) if x < 0.68 else invented(r) if x < 0.74 else (invented(r, 4).capitalize() if lang == "de" or x < 0.755 else invented(r, 4)) if x < 0.79
            else _cap(r) if x < 0.82 else _place(r) if x < 0.86 else _digits(r, r.choice(["#", "##", "##", "###", "####", "##.#", "##-##"])) if x < 0.93 else _code(r) if x < 0.95 else _cap(r) + " " + invented(r) + r.choice(LATIN) if x < 0.965 else r.choice(SALAD[lang]) + "-" + r.choice(SALAD[lang]) if x < 0.975 else r.choice(SALAD[lang]).capitalize()
        )
        out.append(word + (r.choice([",", ",", ",", ";", ":"]) if r.random() < 0.07 else ""))
    text = " ".join(out).rstrip(",;:")
    return text[0].upper() + text[1:] + r.choice([".", ".", ".", ".", "?", ""])


def _slots(r: random.Random, lang: str) -> dict:
    low = lambda: r.choice(SALAD["en"]) if r.random() < 0.7 else invented(r)
    words = lambda: " ".join(r.choice(SMALL[lang]) if r.random() < 0.4 else r.choice(SALAD[lang]) if r.random() < 0.85 else invented(r) for _ in range(r.randrange(1, 6)))
    binomial = lambda: _cap(r)[:14] + (f" {invented(r)}{r.choice(LATIN)}" if r.random() < 0.6 else r.choice(LATIN))
    return {
        "salad": lambda: _salad(r, lang), "name": lambda: _name(r), "email": lambda: _email(r), "addr": lambda: _address(r, lang),
        "phone": lambda: _digits(r, r.choice(PHONE[lang if r.random() < 0.5 else r.choice("en de fr es".split())])),
        "id": lambda: (lambda s: s.lower() if r.random() < 0.15 else s)(_digits(r, r.choice(ID[lang if r.random() < 0.6 else r.choice("en de fr es".split())]))),
        "town": lambda: _town(r), "place": lambda: _place(r), "cap": lambda: _cap(r), "word": low, "Word": lambda: low().capitalize(), "Title": lambda: low().capitalize(), "UPPER": lambda: low().upper(),
        "words": words, "Words": lambda: words().capitalize(), "record": lambda: r.choice(RECORD), "Record": lambda: r.choice(RECORD).capitalize(),
        "number": lambda: r.choice([_digit_groups, _code, lambda q: _digits(q, q.choice(PHONE[q.choice("en de fr es".split())])).lstrip("+("), lambda q: _digits(q, q.choice(["### ### ####", "##########", "###-####", "########", "####-####-##", "### ### ###"])), lambda q: _digits(q, q.choice(ID[q.choice("en de fr es".split())]))])(r), "road": lambda: r.choice("row lane court place way hill walk close drive square terrace garden".split()), "Noun": lambda: r.choice([w for w in SALAD["de"] if w[0].isupper()] + ["Stück", "Flaschen", "Gramm", "Sorten", "Kisten"]), "mojibake": lambda: (invented(r) + r.choice(["é", "ü", "ñ", "à"]) + invented(r)).encode().decode("latin-1"),
        "binomial": binomial, "Binomial": binomial, "role": lambda: r.choice(ROLE), "title": lambda: r.choice(TITLE), "org": lambda: r.choice(ORG), "ship": lambda: r.choice(SHIP), "month": lambda: r.choice(MONTH),
        "code": lambda: _code(r), "digits": lambda: _digit_groups(r), "hash": lambda: "".join(r.choice("0123456789abcdef") for _ in range(r.choice([7, 10, 12]))), "version": lambda: ".".join(str(r.randrange(0, r.choice([10, 100, 1000]))) for _ in range(r.randrange(2, 4))),
        "date": lambda: _digits(r, r.choice(["20##-0#-1#", "1#.0#.20##", "0#/1#/20##", "20##0#1#", "1# May 20##", "20##0#1#_######"])), "time": lambda: _digits(r, r.choice(["1#:##", "0#.##", "#:##", "1# h ##"])),
    }


KINDS = {"name": "person_name", "email": "email", "phone": "phone", "id": "id_number", "addr": "address"}


def _filled(r: random.Random, template: str, lang: str) -> tuple[str, list[tuple[int, int, str]]]:
    fill, text, spans = _slots(r, lang), "", []
    for piece in re.split(r"(\{\w+\})", template):
        if piece[:1] == "{":
            value = fill[piece[1:-1]]()
            if piece[1:-1] in KINDS:
                spans.append((len(text), len(text) + len(value), KINDS[piece[1:-1]]))
            text += value
        elif "#" in piece.strip("# "):
            text += re.sub("#", lambda _: r.choice("0123456789"), piece)
        else:  # only marks of a heading
            text += piece
    return text, spans


def labelled(copies: int = 8, seed: int = 7) -> list[tuple[str, list[tuple[int, int, str]]]]:
    """Lines of one to four sentences with their spans (start, end, kind); each template about ``copies`` times, those that hold something more often."""
    r = random.Random(seed)
    one: list[tuple[str, str]] = []
    for lang in HELD:
        for t, n in (("{name} {words}.", 22), ("{Words} {name} {words}.", 16), ("{Words} {name}.", 3), ("{Words}, {name} {words}.", 3), ("{Words} {name}, {words}.", 4), ("{Word} = {name}; {words}", 2), ("{word}: {name}", 3), ("{Words}: {name}.", 4), ("{Word}: {name} {Words}.", 3), ("{Word} {name} {words}.", 5), ("{Words} {name} {words} {words}.", 5), ("{Words} {email} {words}.", 3), ("{word}={email}", 1), ("{Words} {addr}, {words}.", 5), ("{Words} {addr} {words}.", 5), ("{word} {addr}.", 3), ("{Words}: {addr}.", 4), ("{Word}: {addr}", 4), ("{Words} {addr} {words}.", 5)):
            one += [(lang, t)] * (n * copies)
        one += [(lang, t) for t in {"en": ["{Words} of {name} {words}.", "{Words} by {name} {words}."], "de": ["{Noun} von {name} {words}.", "{Noun} durch {name} {words}.", "{Noun} {name} {words}."], "fr": ["{Words} de {name} {words}.", "{Words} par {name}, {words}."], "es": ["{Words} de {name} {words}.", "{Words} por {name}, {words}."]}[lang] for _ in range(4 * copies)]
        for t in CALL[lang]:
            one += [(lang, f"{{Words}} {{phone}} {t.lower()}."), (lang, "{phone} ({words})"), (lang, f"{t} {{phone}} {{words}}."), (lang, f"{t} {{phone}}"), (lang, f"{{Words}} {t.lower()} {{phone}}, {{words}}.")] * copies
        for t in PAPER[lang]:
            one += [(lang, f"{t} {{id}} {{words}}."), (lang, f"{t} {{id}}"), (lang, f"{{Words}} {t} {{id}}, {{words}}.")] * copies
        one += [(lang, t) for t in HELD[lang] for _ in range(2 * copies)] + [(lang, t) for t in FREE[lang] for _ in range(copies)]
        for _ in range(45 * copies):  # signatures
            fields = r.sample(FIELD, r.choice([1, 1, 2, 2, 3, 4]))
            mark = r.choice(JOIN)
            one.append((lang, "".join(("" if i == 0 else mark if r.random() < 0.7 else r.choice(JOIN)) + "{" + f + "}" for i, f in enumerate(fields))))
    r.shuffle(one)
    out, at = [], 0
    while at < len(one):
        n = r.choice([1, 1, 2, 3, 4])
        text, spans = r.choice(["", "", "", "", "", "- ", "# ", "> ", "\t"]), []
        for lang, template in one[at : at + n]:
            piece, own = _filled(r, template, lang)
            if not own and r.random() < 0.08:
                piece = piece.upper()
            if text.strip():
                text += r.choice([" ", " ", " ", "  "])
            spans += [(a + len(text), b + len(text), k) for a, b, k in own]
            text += piece
        at += n
        out.append((text, spans))
    return out
