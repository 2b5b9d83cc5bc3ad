"""A small labelled table of addresses with personal information, written by a rule.

No labelled rows come with the data, so the table is made: each row is put together from the forms that free-text addresses
take, with every word's label known. Names, places and mail domains are ordinary ones (fixed values below) or are spelt at random; none is taken from
a table that the model is meant for, and tests compare them with the test tables. The forms themselves (cues such as S/O, units, ends of
streets, areas and firms) are those of Indian postal addresses.
"""

from __future__ import annotations

import random

KINDS = ["person", "email", "phone", "identity", "address"]
FIRST = (
    "AARAV ABBAS ADITYA AHMED AJAY AKASH ALOK AMIT AMRITA ANAND ANIL ANJALI ANKIT ANUPAMA APARNA ARJUN ARUN ASHA ASHOK BALAJI BHARAT BHAVNA CHANDAN CHETAN DEEPAK DEEPTI DHRUV DILIP DIVYA FARHAN FATIMA GAURAV GEETA GOVIND HASAN HARISH HEMANT IMRAN INDIRA "
    "ISHAAN JAGDISH JAYA JITENDRA JYOTI KAILASH KAMALA KARAN KARIM KAVITA KIRAN KISHORE KRISHNA LALIT LATA MADHAV MANISH MANOJ MEERA MOHAN MUKESH NANDINI NAVEEN NEHA NASIR NILESH NIRMALA NITIN OMKAR PANKAJ POOJA PRADEEP PRAKASH PRASAD PRATIMA PREM RADHA "
    "RAHUL RAJAT RAMESH RANJIT RASHID REKHA ROHAN RUBINA SACHIN SALMA SANDEEP SANJAY SARITA SATISH SEEMA SHANKAR SHEELA SHIVANI SHYAM SMITA SNEHA SUBHASH SUDHA SUJATA SURESH SUSHMA SWATI TANVI TARUN UDAY UMESH VARSHA VASANT VIJAY VIKRAM VINAY VIVEK YASH YUSUF ZAKIR ZOYA "
    "ALICE ANDREW CAROL DANIEL DAVID EDWARD EMMA GEORGE HELEN JAMES JOHN JOSEPH LAURA MARIA MARTIN MICHAEL NANCY PAUL PETER ROBERT SARAH STEPHEN SUSAN THOMAS WILLIAM"
).split()
LAST = (
    "ACHARYA AGARWAL AHUJA ANSARI APTE ARORA BAJAJ BALAKRISHNAN BANERJEE BASU BHARGAVA BHATIA BHAT BHOSALE BISWAS BOSE CHAKRABORTY CHANDRA CHATTERJEE CHAUHAN CHOPRA CHOUDHARY DALAL DATTA DHAWAN DIXIT DUBEY DUTTA GADKARI GANDHI GARG GHOSH GILL GOKHALE GOWDA GUPTA HEGDE HUSSAIN IYER JADHAV JAIN JHA JOSHI KADAM "
    "KAMATH KAPOOR KARANDIKAR KAUR KHAN KHANNA KOHLI KRISHNAN KULKARNI MAHAJAN MALHOTRA MALIK MATHUR MEHTA MISHRA MITRA MODI MUKHERJEE MURTHY NADAR NAIDU NAIK NAIR NAMBIAR NANDA NATARAJAN PANDEY PAREKH PATEL PATIL PAWAR PILLAI PRABHU RAMASWAMY RAMAN RANGANATHAN RAO RASTOGI RATHORE REDDY ROY SAHA SAWANT SAXENA "
    "SEN SETHI SHAH SHAIKH SHETTY SHINDE SHUKLA SINGH SINHA SIDDIQUI SOLANKI SRINIVASAN SUBRAMANIAM TAMBE TANDON THAKUR TIWARI TRIPATHI TRIVEDI UPADHYAY VARGHESE VARMA VENKATARAMAN VERMA VYAS WADEKAR YADAV ZAVERI "
    "ADAMS BAKER BROWN CLARK COLLINS DSOUZA EVANS FERNANDES HARRIS JACKSON JOHNSON LEWIS MILLER MOORE PEREIRA SMITH TAYLOR TURNER WALKER WILSON"
).split()
#: Roots and ends from which further given names and surnames are put together.
ROOTS = "AMAR BAL CHAND DEV GAJ GIR HEM INDU JAG JAI KAMAL LOK MAN MUKT NAG NITY PADM PRABH RAGH RAM RATN SATY SHIV SOM SUR TEJ UM VAS VIR YOG".split()
GIVEN_ENDS = "ESH ENDRA INDER ANATH APPA AMMA ANAND ITA INI DEEP PAL RAJ DAS VEER JEET MANI PRIYA WATI DEVI LAL KANT NANDAN".split()
SUR_ENDS = "KAR EKAR WALA ANI APPA AIAH SWAMY AN AIYAR ATH KOTI PALLI GIRI RAJU PUTRA WAL".split()
BRANDS = "PRESTIGE BRIGADE SOBHA GODREJ LODHA HIRANANDANI RAHEJA OBEROI KALPATARU PURAVANKARA EMBASSY SALARPURIA MANTRI TATA SHRIRAM ADARSH MAHINDRA UNITECH ANSAL OMAXE PARSVNATH ELDECO GAURS SUPERTECH AMRAPALI KOLTE MARATHON RUSTOMJEE WADHWA SUNTECK DLF".split()
TITLES = "SUNSHINE GREEN ROYAL PALM VIEW SILVER GOLDEN OAK MAPLE ORCHID LOTUS ROSE RIVER VALLEY SPRING CRYSTAL PEARL EMERALD DIAMOND STAR MOON SKY GRAND FIELD MEADOW HILL OCEAN SEA BREEZE WHITE BLUE".split()
CITIES = "MUMBAI DELHI CHENNAI KOLKATA HYDERABAD BENGALURU NAGPUR INDORE BHOPAL JAIPUR LUCKNOW SURAT VADODARA RAJKOT NASHIK MYSURU MANGALURU KOCHI MADURAI SALEM PATNA RANCHI KANPUR AGRA GOA NOIDA THANE".split()
STEMS = "INDIRA SHIVAJI JAWAHAR SUBHASH TILAK AZAD LAXMI SARASWATI GANESH HANUMAN VIVEKANANDA TAGORE RAJAJI PATEL ASHOKA VIJAYA SHANTI ANANDA MAHATMA STATION CHURCH MARKET HOSPITAL COLLEGE FORT BEACH MILL".split()
AREAS = ["NAGAR", "NGR", "GARDENS", "GDNS", "HALLI", "VIHAR", "WADI", "PETE", "LAYOUT", "LYT", "EXTENSION", "EXTN", "PURAM", "PM", "COLONY", "CLNY"]
STREETS = ["STREET", "ST", "STR", "STRT", "ROAD", "RD", "RD.", "RAOD", "LANE", "LN", "MARG", "MRG", "CROSS", "CRS", "X", "MAIN ROAD", "MN RD", "MAIN RD"]
ENDINGS = ["RESIDENCY", "RESI", "ENCLAVE", "ENCL", "HABITAT", "HEIGHTS", "HTS", "TOWERS", "TWRS", "TOWER", "APARTMENT", "APARTMENTS", "APTS", "APPT", "GARDENS", "GDNS", "PHASE I", "PHASE II", "PHASE 1", "PHASE 2", "PH 1", "PH 2", "", "", "", ""]
FIRMS = ["TRADERS PVT LTD", "FOODS LLP", "ENTERPRISES", "LOGISTICS LTD", "TRADERS", "INDUSTRIES LTD", "STORES", "AGENCIES", "FOODS PVT LTD", "LOGISTICS", "SERVICES LTD", "TECHNOLOGIES PVT LTD", "SOLUTIONS LLP", "MOTORS", "TEXTILES LTD"]
FURTHER = ["NATIVE", "NATIVE PLACE", "ALSO AT", "OLD ADDRESS", "OLD ADD", "PREV ADD", "OFFICE:", "WORKS AT", "R/O", "PERM ADD:", "PERMANENT ADDRESS", "RES ADD"]
METERS = ["METER NO", "KHATA", "SY NO", "RR NO", "CONSUMER NO", "PLOT NO", "ACCOUNT NO"]
DOMAINS = ["gmail", "yahoo", "hotmail", "outlook", "rediffmail", "proton", "icloud", "zoho", "sify", "live"]
TOPS = ["com", "in", "org", "net", "co.in", "info", "online"]
SINGLE = "BCDFGHJKLMNPRSTVWXYZ"
ONSETS, NUCLEI, CODAS = "B BH BR CH D DH DR F G GR H J K KH KR L M N P PH PR R S SH SR ST T TH TR V W Y Z".split(), "A AA AI E EE I IA O OO U".split(), ["", "", "", "", "L", "M", "N", "NT", "R", "SH", "T", "V"]


class Maker:
    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def word(self, syllables: int) -> str:
        """A made-up word: half of them of open syllables with single letters, half with clusters, long vowels and closed syllables."""
        if self.r.random() < 0.6:
            w = "".join(self.r.choice(SINGLE) + self.r.choice("AEIOU") for _ in range(syllables))
            end = self.r.random()
            return w + self.r.choice("LMNRST") if end < 0.12 else w[1:] if end < 0.2 else w
        return "".join(self.r.choice(ONSETS) + self.r.choice(NUCLEI) + (self.r.choice(CODAS) if k else "") for k in range(syllables))

    def given(self) -> str:
        return self.r.choice(FIRST) if self.r.random() < 0.5 else self.r.choice(ROOTS) + self.r.choice(GIVEN_ENDS)

    def surname(self) -> str:
        return self.r.choice(LAST) if self.r.random() < 0.5 else self.r.choice(ROOTS) + self.r.choice(SUR_ENDS)

    def stem(self) -> str:
        return self.r.choice(STEMS) if self.r.random() < 0.15 else self.slip(self.word(self.r.choice([2, 3, 3])))

    def slip(self, w: str) -> str:
        """Now and then a word with a letter lost, doubled, changed or exchanged."""
        if len(w) < 5 or self.r.random() > 0.08:
            return w
        i = self.r.randrange(len(w) - 1)
        return self.r.choice([w[:i] + w[i + 1 :], w[:i] + w[i] + w[i:], w[:i] + self.r.choice("AEIOUNRSTH") + w[i + 1 :], w[:i] + w[i + 1] + w[i] + w[i + 2 :]])

    def digits(self, n: int) -> str:
        return "".join(self.r.choice("0123456789") for _ in range(n))

    def letters(self, n: int) -> str:
        return "".join(self.r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ") for _ in range(n))

    def flat(self) -> str:
        n, w = self.r.choice("123456789") + self.digits(self.r.choice([2, 3])), self.r.choice("ABCDEFGHJKLM")
        return self.r.choice([f"FLAT NO {n} {w} WING", f"FLT {n} TOWER {w}", f"BLOCK {w} FLAT {n}", f"F NO {w}/{n}", f"{n}, {w} BLOCK", f"{w}-{n}", f"{w} {n}", f"FLAT {n}", f"FLT NO {n}", f"APT {n}", f"UNIT {n}", f"#{n}", n])

    def house(self) -> str:
        n = str(self.r.randrange(1, 240)) + self.r.choice(["", "", "A", "B", "C", f"/{self.r.randrange(1, 21)}"])
        return self.r.choice([f"NO {n}", f"NO.{n}", f"H NO {n}", f"HOUSE NO {n}", f"D.NO {n}", f"DOOR NO {n}", f"#{n}", n])

    def project(self) -> str:
        brand = self.r.choice(BRANDS) if self.r.random() < 0.35 else self.word(self.r.choice([2, 3]))
        name = " ".join(self.r.sample(TITLES, self.r.choice([1, 1, 2]))) if self.r.random() < 0.15 else self.slip(self.word(self.r.choice([2, 3, 4])))
        both = f"{brand}{name}" if self.r.random() < 0.05 else f"{brand} {name}" if self.r.random() < 0.9 else name
        return f"{both} {self.r.choice(ENDINGS)}".strip()

    def place(self) -> list[str]:
        """The parts of a postal address."""
        if self.r.random() < 0.6:
            parts = [f"{self.flat()} {self.project()}"]
        else:
            parts = [f"{self.house()} {self.stem()} {self.word(2) + ' ' if self.r.random() < 0.75 else ''}{self.r.choice(STREETS)}"]
            if self.r.random() < 0.12:
                parts.append(f"{self.given()} {self.r.choice(['NIVAS', 'BHAVAN', 'SADAN', 'KUTIR', 'VILLA'])}")
                self.r.shuffle(parts)
        if self.r.random() < 0.85:
            area = self.r.choice(AREAS)
            parts.append(f"{self.stem()}{'' if self.r.random() < 0.06 else ' '}{area}")
        if self.r.random() < 0.7:
            parts.append(self.slip(self.r.choice(CITIES)) if self.r.random() < 0.3 else self.word(3))
            if self.r.random() < 0.1:
                parts.append(parts[-1])
        if self.r.random() < 0.4:
            pin = self.r.choice("23456") + self.digits(5)
            parts.append(f"{pin[:3]} {pin[3:]}" if self.r.random() < 0.25 else pin)
        if self.r.random() < 0.12:
            self.r.shuffle(parts)
        return parts

    def person(self) -> tuple[str, str]:
        """(words before the name that aren't part of it, name). After a cue a name may be any words, without one it is a name's own spelling that tells."""
        cue = self.r.choice(["S/O", "W/O", "D/O", "D/O.", "S/O.", "C/O", "C/O", "C/O", "H/O", "CARE OF", "SON OF", "WIFE OF", "DAUGHTER OF", "ATTN", "KIND ATTN:", "ATTN:", "MR", "MR.", "MS", "MRS", "MRS.", "SHRI", "SMT", "DR", "OWNER", "OWNER:", "KIND ATTN: MS", "ATTN: MR", "", ""])
        odd = cue and self.r.random() < 0.35
        f, last, i = (self.word(self.r.choice([2, 3, 4])) if odd else self.given()), (self.word(self.r.choice([2, 3])) if odd else self.surname()), self.r.choice("ABCDGHJKLMNPRSTVY")
        name = self.r.choice([f"{f} {last}", f"{f} {last}", f"{last} {f}", f"{f} {i} {last}", f"{f} {i}. {last}", f"{i} {last}" if cue else f"{i} {f} {last}", f"{f} {last}", f"{f} {self.given()} {last}", f"{f} {self.given()} {self.given()} {last}" if self.r.random() < 0.3 else f"{f} {self.given()} {last}", f"{last} {f}"])
        late = "LATE " if self.r.random() < 0.15 else ""
        return (f"{cue} {late}".strip() if cue else "", name)

    def email(self) -> tuple[str, str]:
        user = self.given() + self.r.choice(["", ".", "_"]) + self.surname() + self.r.choice(["", self.digits(1), self.digits(2)])
        d, t = self.r.choice(DOMAINS) if self.r.random() < 0.4 else self.word(2).lower(), self.r.choice(TOPS) if self.r.random() < 0.7 else self.word(self.r.choice([1, 2])).lower()
        mail = self.r.choice([f"{user}@{d}.{t}"] * 5 + [f"{user}@ {d}.{t}", f"{user} (at) {d}.{t}", f"{user}[at]{d} dot {t}", f"{user} [at] {d} dot {t}"])
        mail = mail if self.r.random() < 0.3 else mail.lower()
        if self.r.random() < 0.12:
            return "", f"E-MAIL-{mail}"
        return self.r.choice(["", "", "", "EMAIL", "MAIL ID:", "MAIL"]), mail

    def phone(self) -> tuple[str, str]:
        n = self.r.choice("56789") + self.digits(9)
        form = self.r.randrange(8)
        if form == 0:
            return self.r.choice(["", "", "MOB", "PH"]), f"91{n}"
        if form == 1:
            return self.r.choice(["", "CALL"]), self.r.choice([f"+91 {n[:5]} {n[5:]}", f"+91-{n}", f"+91{n}"])
        if form == 2:
            return self.r.choice(["CALL", "CELL NO", "", "MOB"]), f"{n[:5]}{self.r.choice('- ')}{n[5:]}"
        if form == 3:
            return self.r.choice(["TEL", "PHONE", ""]), f"0{self.digits(2)}-{self.digits(8)}"
        if form == 4:
            return self.r.choice(["PHONE", "TEL"]), f"({self.digits(2)}) {self.digits(8)}"
        if form == 6:
            return "", f"0{n}"
        if form == 5:
            return "", f"{self.r.choice(['MOB:', 'PH:', 'TEL:'])}{n}"
        return self.r.choice(["", "", "PH", "CELL", "CALL", "CONTACT"]), n

    def identity(self) -> tuple[str, str]:
        a = self.digits(12)
        pan = f"{self.letters(5)}{self.digits(4)}{self.letters(1)}"
        forms = [("AADHAR NO", a), ("ID PROOF", a), ("UID", f"{a[:4]} {a[4:8]} {a[8:]}"), ("", f"{a[:4]} {a[4:8]} {a[8:]}"), ("", f"{a[:4]}-{a[4:8]}-{a[8:]}"), ("AADHAR", f"{a[:4]} {a[4:8]} {a[8:]}"), ("PAN", pan), ("PAN", pan), ("", f"NO:{pan}"), ("", pan), ("PASSPORT", f"{self.letters(1)}{self.digits(7)}"), ("VOTER ID", f"{self.letters(3)}{self.digits(7)}"), ("EPIC", f"{self.letters(3)}{self.digits(7)}"), ("DL NO", f"{self.letters(2)}{self.digits(2)} {self.digits(11)}"), ("DL NO", f"{self.letters(2)}{self.digits(13)}"), ("", f"{self.letters(2)}{self.digits(2)} {self.digits(11)}")]
        return self.r.choice(forms)

    def row(self) -> list[tuple[str, str | None]]:
        """(words, kind or None) one after the other."""
        out: list[tuple[str, str | None]] = [(p, None) for p in self.place()]
        r = self.r.random
        if r() < 0.35:
            where = self.r.choice(["NEAR", "NR", "OPP", "BEHIND", "NEXT TO"])
            what = self.r.choice(["PARK", "SCHOOL", "MARKET", "HOSPITAL", "WATER TANK", "TEMPLE", "POST OFFICE", "BUS STAND", "LAKE", "GOVT SCHOOL"]) if r() < 0.5 else self.project()
            out.insert(self.r.randrange(1, len(out) + 1), (f"{where} {what}", None))
        if r() < 0.15:
            out.insert(self.r.randrange(1, len(out) + 1), (self.r.choice(["2ND FLOOR", "FIRST FLOOR", "GROUND FLR", "3RD FLR", "SHOP @ CORNER"]), None))
        if r() < 0.25:
            out.insert(self.r.randrange(1, len(out) + 1), (f"{self.r.choice(METERS)} {self.digits(self.r.choice([6, 7, 8, 9, 10]))}", None))
        if r() < 0.12:
            out.insert(0, (f"{self.r.choice(['M/S', 'ATTN', 'C/O', 'C/O', 'KIND ATTN:', ''])} {self.r.choice(BRANDS) if self.r.random() < 0.3 else self.word(3)} {self.r.choice(FIRMS)}".strip(), None))
        if r() < 0.2:
            cue, first = self.r.choice(FURTHER), self.place()
            out.append((f"{cue} {' '.join(first)}", "address"))
        for make, kind, share in ((self.person, "person", 0.35), (self.email, "email", 0.18), (self.phone, "phone", 0.25), (self.identity, "identity", 0.22)):
            if r() < share:
                cue, what = make()
                at = len(out) if r() < 0.4 else 0 if kind == "person" and r() < 0.75 else self.r.randrange(0, len(out) + 1)
                out[at:at] = [*([(cue, None)] if cue else []), (what, kind)]
        return out


def labelled_rows(n: int = 2000, seed: int = 20_260_923) -> list[tuple[str, list[tuple[int, int, str]]]]:
    """(address, spans (from, to, kind)) of n rows."""
    m, rows = Maker(seed), []
    for _ in range(n):
        sep = m.r.choice([" ", " ", ", ", ",", "; ", "  "])
        title = m.r.random() < 0.06
        text, spans, cue = "", [], False
        for words, kind in m.row():
            text += ("" if not text else " " if cue and kind else sep)
            if kind:
                spans.append((len(text), len(text) + len(words), kind))
            cue = kind is None and (words.endswith(":") or words in ("S/O", "W/O", "D/O", "D/O.", "S/O.", "C/O", "H/O", "ATTN", "MR", "MR.", "MS", "MRS", "MRS.", "SHRI", "SMT", "DR", "OWNER", "PAN", "EPIC", "UID", "EMAIL", "MAIL", "CALL", "TEL", "PH") or words.split(" ")[-1] in ("OF", "LATE", "NO", "ID", "PROOF", "PASSPORT", "AADHAR"))
            text += words
        if m.r.random() < 0.04:
            text += "######"
        rows.append((text.title() if title else text, spans))
    return rows
