"""Rules for pack descriptions."""

# Type of container, and the tokens that name it.
FORMS = {
    "SYRINGE": ["Fertigspr COP", "Plastik-Fertspr", "Fertigspr", "Fertspr", "Spr"],
    "SYRINGE_AMPOULE": ["Spritzamp", "Zyl Amp"],
    "METERED_SYRINGE": ["Dosierspr"],
    "PEN": ["Fertigpen", "Fertpen"],
    "INJECTOR": ["vorgef Injektor", "Injektor", "Fertinj"],
    "INJECTION_KIT": ["Inj kit"],
    "VIAL": ["Act O Vial", "Durchstfl", "Durchstf", "Onco-Tain", "Cytosafe", "Vial"],
    "AMPOULE": ["Zweik Amp", "Amp"],
    "ORAL_AMPOULE": ["Trinkamp"],
    "BOTTLE": ["Plast Fl", "Glasfl", "Glas Fl", "Tropffl", "Dosierfl", "PP Fl", "Glas", "Fl"],
    "BLISTER": ["PocketPack", "Blist"],
    "SACHET": ["Doppel Btl", "Dppl Btl", "KabiPac", "Stick", "Btl"],
    "BAG": ["Infusionsbtl", "Polybag", "Freeflex"],
    "TUBE": ["Tb"],
    "DISPENSER": ["Dosierpumpe", "Disp", "Ds"],
    "AEROSOL": ["Dosieraeros"],
    "MONODOSE": ["Monodos", "Unidos", "Respule"],
    "CARTRIDGE": ["Patronen", "Patrone"],
    "SET": ["Set"],
    "DAILY_DOSE": ["Tagesdosen"],
    "JAR": ["Topf"],
}
# Units of a pack, of these the ones that count pieces and doses; substance units that can be multiplied.
UNITS = ["ml", "g", "MBq", "GBq", "kBq", "Stk", "Dos", "Dosen"]
PIECES, DOSES = ["Stk"], ["Dos", "Dosen"]
COMPUTABLE = ["mg", "mcg", "g", "UI", "U", "mmol", "Mio U", "Mio UI"]
# Forms after which a hyphenated qualifier is dropped.
QUALIFIED = ["Fertspr", "Durchstf", "Fertpen"]

# Fixed values, in order of trial: name, confidence, shape. F is a form, a b c numbers, u a unit, v one of ml and g.
SHAPES = [
    ("P1_TRIPLE", "HIGH", "F a x b x c u"),
    ("P1B_FORM_MULT", "HIGH", "F a x b u"),
    ("P8B_MULT_FORM_BARE", "MEDIUM", "a x b F"),
    ("P2_MULT_FORM_UNIT", "HIGH", "a x F b u"),
    ("P3_MULT_UNIT", "HIGH", "a x b u"),
    ("P4_N_FORM_VOL", "HIGH", "a F b u"),
    ("P5_FORM_STK", "HIGH", "F a Stk"),
    ("P7_FORM_DOS", "HIGH", "F a Dos"),
    ("P6_FORM_VOL", "HIGH", "F a u"),
    ("P8_N_FORM", "MEDIUM", "a F"),
    ("P11_VOL_ZUR", "MEDIUM", "a v zur text"),
    ("P10_N_N_UNIT", "MEDIUM", "a b u"),
    ("P9_SIMPLE", "HIGH", "a u"),
    ("P14_MONODOS_BTL", "MEDIUM", "a F b Btl à c Stk"),
    ("P12_FORM_STK_VOL", "HIGH", "F a Stk b u"),
    ("P13_VOL_STK", "MEDIUM", "a v b Stk"),
    ("BARE_FORM", "MEDIUM", "F"),
]
