"""Synthetic district folder with the edge cases of FIXTURES.md."""

import os

FILES = {
    "COMPARTIMENTO.csv": "COMPARTIMENTO,NOME_COMPARTIMENTO\nBA,Bari\nBO,Bologna\n",
    "FLAG_QUALITY.csv": (
        "SIGLA_STRUMENTO;TIPO_VALORE;FLAG_VALORE;DESCRIZIONE_FLAG\n"
        "P;Giornaliero;P00;Valore validato\n"
        "P;Massimo;P00;Valore validato\n"
        'T;"Media; oraria";P00;"Valore ""orario"""\n'
        "P;Giornaliero;P*_EC;Valore corretto\n"
        ";Giornaliero;P01;Senza strumento\n"
        "P;Massimo;P00;Valore validato ripetuto\n"),
    "GENERAL_METADATA.csv": (
        "TerritoryName,TimeZone,ApplicationArea,Domain,LevelOfData,DataPolicy,licence,Disclaimer,DataSource,"
        "Funding,ContactPoint,Referece_Author,Referece_Title\n"
        "Italia,Europe/Rome,Hydrology,Meteo,L1,Open,CC BY 4.0,Provisional,Yearbooks,Programme,desk,Servizio,Annali\n"),
    "TIPO_GRANDEZZA.csv": (
        "SIGLA_STRUMENTO,TIPO_GRANDEZZA,SAMPLE_MEDIUM,GRANDEZZA,INTERPOLATION_TYPE,AGGREGATION_PERIOD,DESCRIZIONE_GRANDEZZA\n"
        "P,http://codes.wmo.int/wmdr/ObservedVariableAtmosphere/210,Air,PIOGGIA,Total,P1D,Pioggia giornaliera\n"
        "P,http://codes.wmo.int/wmdr/ObservedVariableAtmosphere/210,Air,PIOGGIA_MAX_1H,Maximum,PT1H,Massimo orario\n"
        "T,http://codes.wmo.int/wmdr/ObservedVariableAtmosphere/224,Air,TEMP_MEDIA,Average,P1D,Temperatura media\n"
        "I,urn:level,Water,LIVELLO,Continuous,bad,Livello\n"),
    "TIPO_STRUMENTO.csv": (
        "SIGLA_STRUMENTO,CATEGORIA_STRUMENTO,TIPO_STRUMENTO_ANNALE,DESCRIZIONE_TIPO_STRUMENTO_ANNALE\n"
        "P,Pluviometro,PLV,Pluviometro ordinario\nP,Pluviografo,PLG,Pluviografo\nT,Termometro,TMM,Termometro\n"
        "I,Idrometro,IDRÒ,Idrometro\n"),
    "UNITA_MISURA_UDM.csv": "SIGLA_STRUMENTO,UDM,DESCRIZIONE_UDM\nP,mm,millimetri\nT,°C,gradi Celsius\n",
    "ENTE_COMPILATORE_rev.csv": (
        "SIGLA_ENTE_COMPILATORE,NOME_ENTE_COMPILATORE,RUOLO_ENTE_COMPILATORE,EmailpuntoContatto,RUOLO_PROGETTO,GENERAL\n"
        'UIBA,Ufficio Idrografico di Bari,"editor, publisher",uiba@example.org,partner,Y\n'
        "UIBO,Ufficio di Forlì,owner,,partner,y\n"
        "UIXX,Altro ufficio,publisher,x@example.org,partner,N\n"),
    "BARI/STAZIONI_BA_PeT.csv": (
        "﻿Compartimento;ALIAS_BACINO;ALIAS_STAZIONE;X_LONG;Y_LAT;Z_MSLM\n"
        "BA;OFANTO;CANOSA;16,0000;41,0000;100.0\n"
        "BA;OFANTO;CANOSA;16,0667;41,2214;105.5\n"
        "BA;CARAPELLE;ASCOLI (S.) - D'ORO;15,5667;41,2000;-3\n"
        "BA;FORTORE;SENZA SERIE;15,0;41,5;\n"),
    "BARI/SERIE_TEMPORALI_BA.csv": (
        "COMPARTIMENTO\tALIAS_STAZIONE\tALIAS_BACINO\tTIPO_GRANDEZZA\tGRANDEZZA\tVERSION\tAGGREGATION_PERIOD\n"
        "BA\tCANOSA\tOFANTO\tx\tPIOGGIA\t1\t\n"
        "BA\tCANOSA\tOFANTO\tx\tTEMP_MEDIA\t2\tPT12H\n"
        "ba\tASCOLI (S.) - D'ORO\t\tx\tPIOGGIA\t1\tP2D\n"
        "BA\tASCOLI (S.) - D'ORO\tCARAPELLE\tx\tLIVELLO\t1\t\n"),
    "BARI/SERIE_BROKEN.csv": "COMPARTIMENTO,ALIAS_STAZIONE\nBA,CANOSA\n",
    "BARI/OSSERVAZIONI_BA.csv": (
        "﻿COMPARTIMENTO,ALIAS_BACINO,ALIAS_STAZIONE,GRANDEZZA,PARTE_ANNALE,PAGINA,TABELLA_ORDINE,"
        "NOME_STAZIONE_ANNALE,NOME_BACINO_ANNALE,TIPO_STRUMENTO_ANNALE,QUOTA_STRUMENTO_ANNALE,ANNO,MESE,GIORNO,ORA,"
        "VALORE,FLAG_VALORE,SIGLA_ENTE_COMPILATORE,NOME_COMPILATORE\n"
        "BA,OFANTO,CANOSA,PIOGGIA,I,1,r01,Canosa,Ofanto,PLV,105,1930,01,01,09:00,12.5,P00,UIBA,Rossi\n"
        "BA,OFANTO,CANOSA,PIOGGIA,I,1,r02,Canosa,Ofanto,PLV,105,1930,02,30,09:00,1,P00,UIBA,Rossi\n"
        "BA,OFANTO,CANOSA,PIOGGIA,I,1,r03,Canosa,Ofanto,PLV,105,1930,01,02,24:00,1,P00,UIBA,Rossi\n"
        "BA,OFANTO,CANOSA,PIOGGIA,I,1,r04,Canosa,Ofanto,PLV,105,1930,01,03,0900,1,P00,UIBA,Rossi\n"
        "BA,OFANTO,CANOSA,PIOGGIA,I,1,r05,Canosa,Ofanto,PLV,105,,01,04,09:00,1,P00,UIBA,Rossi\n"
        "BA,OFANTO,CANOSA,PIOGGIA,I,1,r06,Canosa,Ofanto,PLV,105,1930,01,05,09:00,-9999,P00,UIBA,Rossi\n"
        'BA,OFANTO,CANOSA,PIOGGIA,I,1,r07,Canosa,Ofanto,PLV,105,1930,01,06,09:00,"12,5",P00,UIBA,\n'
        'BA,OFANTO,CANOSA,PIOGGIA,I,1,r08,Canosa,Ofanto,PLV,105,1930,01,07,09:00,"1.234,5",XX9,UIBA,Bianchi\n'
        "BA,OFANTO,CANOSA,PIOGGIA,I,1,r09,Canosa,Ofanto,PLV,105,1930,01,08,09:00,NA,P00,UIBA,Rossi\n"
        "BA,OFANTO,CANOSA,PIOGGIA,I,1,r10,Canosa,Ofanto,PLV,105,1930,01,09,09:00,,P00,UIBA,Rossi\n"
        "BA,OFANTO,CANOSA,PIOGGIA,I,1,r11,Canosa,Ofanto,PLV,105,1930,01,10,09:00,3,P00,NOPE,Rossi\n"
        "BA,OFANTO,CANOSA,NEVE,I,1,r12,Canosa,Ofanto,PLV,105,1930,01,11,09:00,3,P00,UIBA,Rossi\n"
        "BA,OFANTO,CANOSA,PIOGGIA,I,1,r13,Canosa,Ofanto,PLV,105,1930,01,01,09:00,13,P*_EC,UIBA,Verdi\n"
        "BA,OFANTO,CANOSA,PIOGGIA,I,1,r14,Canosa,Ofanto,PLV,105,1890,06,01,09:00,2,P00,UIBA,Rossi\n"
        "BA,OFANTO,CANOSA,PIOGGIA,I,1,r15,Canosa,Ofanto,PLV,105,2021,03,28,02:30,2,P00,UIBA,Rossi\n"
        "BA,OFANTO,CANOSA,TEMP_MEDIA,I,2,r16,Canosa,Ofanto,TMM,105,1930,01,01,09:00,4.5,P00,UIBO,Neri\n"
        "BA,CARAPELLE,ASCOLI (S.) - D'ORO,PIOGGIA,II,3,r17,Ascoli,Carapelle,PLG,-3,1931,05,05,08:00,0,P01,UIBA,Rossi\n"),
    "BOLOGNA/OSSERVAZIONI_BO.csv": (
        "COMPARTIMENTO;ALIAS_BACINO;ALIAS_STAZIONE;GRANDEZZA;PARTE_ANNALE;PAGINA;TABELLA_ORDINE;NOME_STAZIONE_ANNALE;"
        "NOME_BACINO_ANNALE;TIPO_STRUMENTO_ANNALE;QUOTA_STRUMENTO_ANNALE;ANNO;MESE;GIORNO;ORA;VALORE;FLAG_VALORE;"
        "SIGLA_ENTE_COMPILATORE;NOME_COMPILATORE\n"
        "PA;RENO;X;PIOGGIA;I;1;r18;X;Reno;PLV;1;1930;01;01;09:00;1;P00;UIBA;Rossi\n"),
    "sta/OSSERVAZIONI_IGNORED.csv": "x\n1\n",
}


def write_fixture(root: str) -> str:
    for rel, body in FILES.items():
        path = os.path.join(root, rel)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w", encoding="utf-8") as f:
            f.write(body)
    return root
