"""Sentences with marked mentions, written before the parsers saw them and without the test tables:
n name, p phone, e email, i id_number, s street.  Not to be tuned to."""

SENTENCES = """\
Bitte bei <n>Maria Schulz</n> unter <p>+49 201 1234567</p> melden.
Der Patient <n>Karl Weber</n> wohnt in der <s>Lindenstr. 12</s>, 45127 Essen.
Ansprechpartnerin: <n>Eva Braun-Klein</n>; Mobil <p>0171 2345678</p>
Herrn <n>Kaya</n> danken wir für die Überweisung.
IBAN <i>DE89 3704 0044 0532 0130 00</i> liegt der Verwaltung vor.
She lives at <s>221B Baker Street</s> in London.
Wir berichten über Herrn <n>Ahmet Yilmaz</n>, geb. 12.03.1961.
Frau <n>Dorothea von Hagen</n> stellte sich am 4. Mai vor.
Hausarzt: Dr. <n>Peter Lang</n>
Kontakt: <e>anna.meier@klinik-nord.de</e> oder telefonisch <p>0201/555-123</p>.
Telefon: <p>(030) 4567 8910</p>
Rückruf erbeten an Prof. Dr. <n>H. Sommer</n>.
Die Patientin <n>Sabine Albrecht</n> lehnt die Untersuchung ab.
Wohnhaft <s>Goethestraße 5a</s>, 80336 München.
Versichertennummer: <i>A123456780</i>
Fallnummer: <i>4711-0815</i>
Please call <n>John Miller</n> on <p>+44 20 7946 0018</p> today.
Seen by Dr. <n>Patel</n> in clinic.
Email <e>j.doe+labs@hospital.org</e> for results.
Medical record number: <i>MR-20391-77</i>
Die Aufnahme erfolgte ohne Kontrastmittel, Schichtdicke 5 mm.
Serie 4, Bild 211 zeigt keine Auffälligkeit.
Gerät: Seriennummer 88123-44, Charge 20231.
Kontrolle in 6 Wochen, RR 120/80 mmHg.
Chefarzt: Prof. <n>Wilhelm Becker</n>
Gespräch mit Frau <n>Öztürk</n> am 03.04.2021 geführt.
Mobil: <p>+43 664 1234567</p>
Anschrift: <s>Am Markt 3</s>, 01067 Dresden
Zuständig ist Oberärztin: <n>Lena Vogt</n>
Überweiser: <n>MÜLLER, Hans</n>
Der Befund wurde Herrn <n>van der Berg</n> ausgehändigt.
Fax <p>089 / 1234 5678</p>, bitte nicht anrufen.
Handynummer <p>0151-23456789</p> notiert.
Reisepass Nr. <i>C01X00T47</i> kopiert.
Die Harnwege sind frei, Atemweg 3 mm.
Das Becken ist stabil, Beckenring 2 cm verbreitert.
Wiedervorstellung am 24.12.2022 um 10:30 Uhr.
Madame <n>Dupont</n> habite <s>12 rue Lafayette</s> à Paris.
Le médecin répond au téléphone <p>+33 1 42 68 53 00</p>.
Contact: <n>Emily Clarke</n>, <e>emily.clarke@nhs.example</e>
Nurse <n>Watson</n> documented the fall.
Der Sohn ist unter <p>0049 172 9988776</p> erreichbar.
Sie zog in die <s>Berliner Allee 44</s> um.
Frau Dr. <n>Ina Krüger</n> befundete die Aufnahmen.
Schreiben Sie an <e>praxis_mueller@web.de</e>.
Sozialversicherungsnummer: <i>65 170839 J 003</i>
ID card <i>L01X00T471</i> was checked.
Betreuer: <n>Thomas Franke</n>, Tel.: <p>0341 998877</p>
Keine Metastasen, Lymphknoten bis 8 mm.
Prof. <n>Schmidt-Rohr</n> bittet um Vorstellung.
Unterschrift: <n>K. Neumann</n>
Die Mutter, Frau <n>Elif Demir</n>, ist informiert.
Physician: <n>Robert Hughes</n>
Radiologist: Dr. <n>Susan Ward</n>
The patient moved to <s>17 Elm Grove Road</s>.
Hospital number: <i>H7782391</i>
Insurance number: <i>QQ 12 34 56 C</i>
Rufnummer <p>0621 45678</p> hinterlegt.
Patientennummer <i>00482913</i> vergeben.
Pat. kommt aus Hamburg, 20095, gut orientiert.
Die Bildgebung vom 12.2020 lag vor; Dosis 2,4 mSv.
Zuweiserin: Dr. med. <n>Carla Stein</n>
Bitte <e>info(at)praxis-stein.de</e> nutzen.
Herr <n>O'Neill</n> wurde entlassen.
"""
